"""Shared helpers of the document operators."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.session import scratch_path

# Fixed by the result contracts: a word is a run of [^\x20\x09-\x0D].
WORD_BREAKS = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    The lineage ends at the written files, so a lost executor costs only the
    step in flight, and every consumer reads the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a staged step that nothing reads any more.

    Only for a frame that :func:`staged` has returned (its folder has a name of
    its own), after what was made of it has been written.
    """
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps.

    The cleaner acts when the driver's unreachable frames are collected; a
    long job on a large heap may go for hours without a collection.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text (null: no words)."""
    flat = F.translate(text_or_empty(text), WORD_BREAKS, " " * len(WORD_BREAKS))
    return F.array_remove(F.split(flat, " "), "")


def id_crc(doc_id: Column) -> Column:
    """Unsigned crc32 of an id written as text (null: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(text_or_empty(text)).cast("long")
