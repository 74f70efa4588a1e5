"""File sources and sinks.

Writers never read and overwrite the same path in one job: a merge result
is written as a new version (``write_version``: a ``_v=<n>`` partition) and
readers follow the newest committed version, so a lost executor or a failed
job leaves the previous version intact.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitchlake.sources.landing import add_metadata


def ingest_to_bronze(spark: SparkSession, path: str, fmt: str, schema: StructType | str | None = None,
                     batch_id: str = "batch", ingest_ts: str = "1970-01-01 00:00:00",
                     source: str = "files", options: dict | None = None) -> DataFrame:
    """Read any file format (explicit schema when given) and add lineage."""
    r = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    return add_metadata(df, batch_id, ingest_ts, source, file_col=True)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Append, optionally partitioned."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Full overwrite (schema included)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet") -> None:
    """Rewrite only the partitions present in ``df`` (dynamic overwrite).

    Idempotent per partition: re-running a round/day replaces exactly it.
    Rows are rebalanced by the partition columns first: each task writes few
    files, and AQE splits a partition that is larger than the advisory size
    over several tasks.
    """
    (df.hint("rebalance", *partition_by)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .format(fmt).partitionBy(*partition_by).save(path))


def write_bucketed(df: DataFrame, table: str, cols: list[str], n: int, sort_cols: list[str] | None = None,
                   path: str | None = None) -> None:
    """Bucket (and sort) a table for repeated joins on ``cols``.

    With ``path`` the table is external (files in a shared folder, not the
    local warehouse directory).
    """
    w = df.write.mode("overwrite").format("parquet").bucketBy(n, *cols)
    if sort_cols:
        w = w.sortBy(*sort_cols)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def copy_by_partition(df: DataFrame, out: str, partition_by: list[str], fmt: str = "parquet"):
    """Copy a table partition by partition -- as ONE partitioned write
    (no driver loop over partition values) -- then validate the copy (Q12)."""
    from pitchlake.operators.quality import validate_copy
    spark = df.sparkSession
    df.hint("rebalance", *partition_by).write.mode("overwrite") \
        .format(fmt).partitionBy(*partition_by).save(out)
    copy = spark.read.format(fmt).load(out)
    return validate_copy(df, copy.select(*df.columns))


VERSION_COL = "_v"


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet table, or None if its path does not exist; any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions of a versioned table (partition values of ``_v``).

    Uses Spark's partition discovery, so it works on any file system the
    cluster mounts (no local directory listing).  The list is bounded by the
    number of versions, not by the data.
    """
    df = read_if_exists(spark, base)
    if df is None:
        return []
    return sorted(r[0] for r in df.select(VERSION_COL).distinct().collect())


def read_version(spark: SparkSession, base: str, version: int | None = None) -> DataFrame | None:
    """One version (default: the newest); the filter prunes to its partition."""
    vs = versions(spark, base)
    if not vs:
        return None
    v = vs[-1] if version is None else version
    return spark.read.parquet(base).filter(F.col(VERSION_COL) == v).drop(VERSION_COL)


def write_version(df: DataFrame, base: str, version: int) -> None:
    """Add ``df`` as version ``version`` of the table under ``base``.

    Each version is its own ``_v=<n>`` partition written by one job; the
    output committer publishes it only when the job commits, so readers never
    see half a version and a failed attempt leaves the older versions intact.
    """
    df.withColumn(VERSION_COL, F.lit(version)).write.mode("append") \
        .partitionBy(VERSION_COL).parquet(base)
