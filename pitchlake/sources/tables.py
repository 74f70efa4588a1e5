"""Reading the driver tables (one parquet file per table)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the driver tables of one scale-factor folder.

    ``shared(name, build)`` memoises a derived frame that several branches of
    one plan consume.  With ``share=True`` (plans with many branches) it is
    written once as parquet under ``spark.checkpoint.dir`` and read back, so
    every branch scans the same files with its own columns and filters pushed
    down.  Otherwise the frame stays lazy and prunes its inputs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, share: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.share = share
        self._memo: dict[str, DataFrame] = {}

    def shared(self, name: str, build) -> DataFrame:
        if name not in self._memo:
            df = build()
            if self.share:
                from pitchlake.session import scratch_path
                path = scratch_path(self.spark, f"{name}-{uuid.uuid4().hex[:12]}")
                df.write.parquet(path)
                df = self.spark.read.schema(df.schema).parquet(path)
            self._memo[name] = df
        return self._memo[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
