"""Corpus pipeline: from raw documents to shards of training data.

Each stage applies one operator of ``pitchlake.llm`` to all that the stage
before has kept.  A stage takes (spark, docs, sf_dir) and returns a frame; the
frame is written as Parquet to the shared folder and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.

1. ``quality``: documents that the classifier rejects go.
2. ``near_duplicates``: one document of each group stays.
3. ``decontaminate``: documents that hold a benchmark item go.
4. ``mix``: documents are left out or repeated until sources meet their targets.
5. ``shards``: every row gets a shard and a slot in it.

An empty table passes through all stages.  What the operators do with nulls,
repeated rows and clashing names is stated in their modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import decontaminate, minhash, mixing, quality_score, sharding
from pitchlake.llm.common import release, staged, table

N_SHARDS = 8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_score.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_documents(docs, mixing.n_words(F.col("text")), F.array("source"))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(docs, sharding.even_tree(N_SHARDS), sharding.even_tree(N_SHARDS + 1))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminated),
          ("mix", mixed), ("shards", sharded)]

#: The classifier and the near-duplicate classes are not SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark)
    return docs
