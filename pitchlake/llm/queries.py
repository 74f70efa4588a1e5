"""One query per operator, over its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import decontaminate, filter_audit, line_dedup, minhash, mixing, prefix_trie, quality_rules, quality_score, repeats, sharding, simhash, toxicity, url_filter, url_lists
from pitchlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Shards of the sharding query, and one more for ``grown_shard``.
N_SHARDS = 8


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("op1_url_filter")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the dated lists on every page at its fetch day."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(url_lists.captures(pages), url_lists.entries(pages))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_score.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_suffix_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 400 bytes cut from all documents."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


@query("op5_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that contaminates it."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and log-likelihood verdict of every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by the law ``key``: doc_id and shard count decide."""
    out = sharding.assign_shards(table(spark, sf_dir, "documents"), sharding.even_tree(N_SHARDS),
                                 sharding.even_tree(N_SHARDS + 1))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"), "grown_shard")


@query("op8_line_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that repeat, or nearly repeat, an earlier line."""
    out = line_dedup.dropped_lines(table(spark, sf_dir, "documents"))
    return out.withColumn("dropped", F.array_join("dropped", ","))


@query("op9_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; each belongs to the one source of its row."""
    docs = table(spark, sf_dir, "documents")
    out = mixing.mix(docs, mixing.n_words(F.col("text")), F.array("source"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op10_minhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op11_filter_audit")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters on all documents, under each of their 120 orders."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_simhash")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and classes of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op13_prefix_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
