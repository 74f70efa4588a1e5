"""ST3: a keyed table whose buckets split as it grows.

A bucket at depth d holds the keys whose hash agrees in its last d bits; its
code is ``2^d + those bits``.  Every bucket is a folder (``data/_k=<code>/
_v=<version>``), and the directory (``manifest``) has a row per published
state: code, version, rows, and whether the bucket still is a leaf.  The
newest row of a code counts.  A table begins with the one bucket of depth 0.

A merge reads and writes the leaves that its keys fall in and no others, so it
costs what its batch touches, whatever the size of the table.  A leaf that
would pass ``rows_per_bucket`` is written as its children instead, in as many
bits as it takes, and they are published together with its end: a reader sees
the leaf or all of its children.  The directory grows with the buckets written,
not with the rows.

Readers see a version once its manifest rows are there.  A replayed version is
skipped if it was published, and otherwise overwrites its own folders.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pitchlake.sources import io as IO

CODE, VERSION = "_k", "_v"
MAX_DEPTH = 30
ROWS_PER_BUCKET = 1_000_000
MANIFEST = f"{CODE} bigint, {VERSION} bigint, n_rows bigint, leaf boolean"


def hash_of(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def code_at(hashed: Column, depth: Column) -> Column:
    """Code of the bucket at ``depth`` that a hash falls in."""
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), depth.cast("int"))
    return size + F.pmod(hashed, size)


def manifest(spark: SparkSession, base: str) -> DataFrame | None:
    found = IO.read_if_exists(spark, f"{base}/manifest")
    return None if found is None else spark.read.schema(MANIFEST).parquet(f"{base}/manifest")


def published(spark: SparkSession, base: str, version: int) -> bool:
    found = manifest(spark, base)
    return found is not None and bool(found.filter(F.col(VERSION) == version).take(1))


def leaves(spark: SparkSession, base: str) -> DataFrame:
    """code, version and rows of the buckets that hold the table (a new table: one empty one)."""
    found = manifest(spark, base)
    if found is None:
        return spark.createDataFrame([(1, -1, 0)], f"{CODE} bigint, {VERSION} bigint, n_rows bigint")
    newest = found.groupBy(CODE).agg(F.max_by(F.struct(VERSION, "n_rows", "leaf"), F.col(VERSION)).alias("_m"))
    return newest.filter("_m.leaf").select(CODE, f"_m.{VERSION}", "_m.n_rows")


def read(spark: SparkSession, base: str) -> DataFrame | None:
    """All rows, with the code and version of their buckets; the directory prunes the folders that are scanned."""
    data = IO.read_if_exists(spark, f"{base}/data")
    if data is None or manifest(spark, base) is None:
        return None
    data = data.withColumns({CODE: F.col(CODE).cast("bigint"), VERSION: F.col(VERSION).cast("bigint")})
    return data.join(F.broadcast(leaves(spark, base).select(CODE, VERSION)), [CODE, VERSION])


def placed(df: DataFrame, keys: list[str], codes: list[int]) -> DataFrame:
    """``df`` with the code of the leaf (of ``codes``) that each row falls in.

    A row is looked up at the depths that occur (31 at most); exactly one of
    them is a leaf.
    """
    depths = sorted({c.bit_length() - 1 for c in codes})
    tried = df.withColumn("_h", hash_of(keys)).withColumn(
        CODE, F.explode(F.array(*[code_at(F.col("_h"), F.lit(d)) for d in depths])))
    directory = df.sparkSession.createDataFrame([(c,) for c in codes], f"{CODE} bigint")
    return tried.join(F.broadcast(directory), CODE, "left_semi").drop("_h")


def merge(batch: DataFrame, base: str, version: int, keys: list[str], combine: Callable[[DataFrame, DataFrame], DataFrame],
          rows_per_bucket: int = ROWS_PER_BUCKET) -> None:
    """Merge ``batch`` (each key once) as ``version``; ``combine(current, new)`` makes the rows of the touched leaves.

    The driver holds the directory: three numbers per leaf.
    """
    spark = batch.sparkSession
    if published(spark, base, version):
        return
    columns = batch.columns
    state = {r[CODE]: (r[VERSION], r["n_rows"]) for r in leaves(spark, base).collect()}
    new = placed(batch, keys, list(state))
    plan = []                                               # (leaf, its depth, depth of what it is written as)
    for r in new.groupBy(CODE).agg(F.count(F.lit(1)).alias("n")).collect():
        depth, rows = r[CODE].bit_length() - 1, state[r[CODE]][1] + r["n"]
        bits = max(0, math.ceil(math.log2(rows / rows_per_bucket)))
        plan.append((r[CODE], depth, min(MAX_DEPTH, depth + bits)))
    if not plan:
        return
    touched = F.broadcast(spark.createDataFrame(plan, "_old bigint, _d int, _to int"))
    rows = new.select(*columns)
    if any(state[c][0] >= 0 for c, _, _ in plan):
        kept = spark.createDataFrame([(c, state[c][0]) for c, _, _ in plan], f"{CODE} bigint, {VERSION} bigint")
        schema = StructType([*batch.schema.fields, StructField(CODE, LongType()), StructField(VERSION, LongType())])
        current = spark.read.schema(schema).parquet(f"{base}/data").join(F.broadcast(kept), [CODE, VERSION], "left_semi")
        rows = combine(current.select(*columns), rows)
    rows = placed(rows.select(*columns), keys, [c for c, _, _ in plan]).join(touched, F.col(CODE) == F.col("_old"))
    rows = rows.withColumn(CODE, code_at(hash_of(keys), F.col("_to"))).select(*columns, CODE).withColumn(VERSION, F.lit(version).cast("bigint"))
    IO.replace_partitions(rows, f"{base}/data", [CODE, VERSION])
    counts = {r[0]: r[1] for r in spark.read.schema(f"{CODE} bigint, {VERSION} bigint").parquet(f"{base}/data")
              .filter(F.col(VERSION) == version).groupBy(CODE).count().collect()}
    # all children of a split, with or without rows, and the end of the bucket that was split
    out = []
    for code, depth, to in plan:
        for i in range(1 << (to - depth)):
            child = (1 << to) + (code - (1 << depth)) + (i << depth)
            out.append((child, version, counts.get(child, 0), True))
        if to > depth:
            out.append((code, version, 0, False))
    spark.createDataFrame(out, MANIFEST).coalesce(1).write.mode("append").parquet(f"{base}/manifest")
