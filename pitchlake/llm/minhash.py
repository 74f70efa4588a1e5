"""Near-duplicates by MinHash with tensored banding, confirmed on full sets.

Two small collections of band hashes are computed per document: ``N_LEFT``
bands of one minhash and ``N_RIGHT`` bands of two.  Every pair (left i,
right j) keys one table, so ``N_LEFT * N_RIGHT`` tables of three minhashes
each cost ``N_LEFT + 2 * N_RIGHT`` minhashes.  Two documents meet in a table
if any left and any right band agree; at Jaccard similarity s they miss with

    1 - (1 - (1 - s)^N_LEFT) * (1 - (1 - s^2)^N_RIGHT)

which at s = 0.75 is 6.5e-5 for 8 and 12, and falls fast above.

1. Documents with equal shingle sets are one node (the least doc_id).
2. Round one: each bucket links its members to its least member.  Pairs are
   confirmed on the full shingle sets; components of confirmed links follow.
3. Round two: documents of buckets that are still in several components are
   open.  Of open documents the pairs between components that can be similar
   at all are found by a prefix filter (two similar sets share one of their
   rarest ``1 - 0.75`` of shingles), and confirmed likewise.  A bucket of true
   copies is one component by then, and a passage that many documents share is
   not among their rarest shingles, so neither is expanded into pairs.
4. Components of all confirmed links.

Before full sets are compared, pairs go whose set sizes rule the similarity
out, or whose signatures agree in fewer than ``LEAST_EQUAL`` places.

Edge cases: null and empty texts, and texts of breaks only, have no shingles
and are linked with nothing (component = own id).  Rows that repeat a doc_id
are judged by their own texts.  A row without a doc_id has a null component
and is not kept.  An empty table gives an empty result.  Only doc_id and text
are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import release, staged
from pitchlake.llm.graph import components
from pitchlake.llm.shingles import common, mix, shingle_sets

N_LEFT = 8
N_RIGHT = 12
N_HASHES = N_LEFT + 2 * N_RIGHT
#: 100 * intersection >= SIMILARITY * union
SIMILARITY = 75
#: Fewer equal minhashes of 32 have a chance of 4e-7 at similarity 0.75.
LEAST_EQUAL = 11
#: Documents looked at, and shingles kept, for the order of the prefix filter.
SAMPLE = 8192
FREQUENT = 1 << 17

_RNG = np.random.default_rng(11)
_MUL = _RNG.integers(1, 1 << 63, N_HASHES, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, N_HASHES, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``N_HASHES`` minhashes of a set."""
    return np.array([(shingles * m + a).min() >> np.uint64(32) for m, a in zip(_MUL, _ADD, strict=True)], np.uint32)


def table_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of the ``N_LEFT * N_RIGHT`` tables, from signatures of shape (n, N_HASHES)."""
    s = signatures.astype(np.uint64)
    left = mix(s[:, :N_LEFT] + (np.arange(N_LEFT, dtype=np.uint64) << np.uint64(34)))
    pair = (s[:, N_LEFT::2] << np.uint64(32)) | s[:, N_LEFT + 1::2]
    right = mix(mix(pair) + np.arange(N_RIGHT, dtype=np.uint64))
    return mix(left[:, :, None] + right[:, None, :] * np.uint64(0x9E3779B97F4A7C15)).reshape(len(s), -1)


def profiles(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the set), signature of every row."""
    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n, key, sig = [], [], []
            for s in shingle_sets(pdf["text"]):
                n.append(len(s))
                key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "n_shingles": n, "set_key": key,
                                "signature": sig})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInPandas(part, "doc_id long, n_shingles long, set_key binary, signature binary")


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """(key, node) of every node in every table; ``nodes``: node, signature."""
    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                keys = table_keys(np.frombuffer(b"".join(pdf["signature"]), np.uint32).reshape(len(pdf), -1))
                yield pd.DataFrame({"key": keys.view(np.int64).reshape(-1),
                                    "node": np.repeat(pdf["node"].to_numpy(), keys.shape[1])})
    return nodes.select("node", "signature").mapInPandas(part, "key long, node long")


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, s (the sorted set as bytes) of the documents in ``nodes``."""
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"node": pdf["doc_id"], "s": [s.tobytes() for s in shingle_sets(pdf["text"])]})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").mapInPandas(sets, "node long, s binary")


def plausible(pairs: DataFrame, nodes: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Pairs whose set sizes allow the similarity, and with ``LEAST_EQUAL`` equal minhashes or more."""
    def agree(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, y = (np.frombuffer(b"".join(pdf[c]), np.uint32).reshape(len(pdf), -1) for c in ("xa", "xb"))
            yield pdf.loc[(x == y).sum(axis=1) >= LEAST_EQUAL, ["a", "b"]]

    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("signature").alias("xa"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("xb"))
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * similarity
    return pairs.join(one, "a").join(two, "b").filter(near).select("a", "b", "xa", "xb").mapInPandas(agree, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = []
            for x, y in zip(pdf["sa"], pdf["sb"], strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = common(p, q)
                ok.append(bool(both) and 100 * both >= similarity * (len(p) + len(q) - both))
            yield pdf.loc[ok, ["a", "b"]]

    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b"))
    return both.select("a", "b", "sa", "sb").mapInPandas(check, "a long, b long")


def frequent_shingles(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many open documents share, and how many do, from about ``SAMPLE`` documents.

    Only an order is made of it, and the prefix filter is exact for any order.
    """
    def shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            flat = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["s"]] + [np.zeros(0, np.uint64)])
            yield pd.DataFrame({"shingle": flat.view(np.int64)})

    n = max(1, sets.count())
    some = sets.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / n) * (1 << 30)))
    top = (some.mapInPandas(shingles, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
           .orderBy(F.desc("n"), "shingle").limit(FREQUENT).toPandas())
    values = top["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], top["n"].to_numpy(np.int64)[order]


def prefix_rows(sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """shingle, node, pos: the rarest shingles of each set in order, of which two similar sets share one at least."""
    known, counts = frequent_shingles(sets)
    sent = sets.sparkSession.sparkContext.broadcast((known, counts))         # FREQUENT entries

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, counts = sent.value
        for pdf in batches:
            out, nodes, places = [], [], []
            for node, x in zip(pdf["node"], pdf["s"], strict=True):
                s = np.frombuffer(x, np.uint64)
                n = np.zeros(len(s), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    n = np.where(known[at] == s, counts[at], 0)
                size = len(s) - -(-similarity * len(s) // 100) + 1
                out.append(s[np.lexsort((s, n))][:size])
                nodes.append(np.full(size, node))
                places.append(np.arange(size))
            if out:
                yield pd.DataFrame({"shingle": np.concatenate(out).view(np.int64), "node": np.concatenate(nodes),
                                    "pos": np.concatenate(places)})
    return sets.mapInPandas(part, "shingle long, node long, pos int")


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    spark = docs.sparkSession
    rows = staged(profiles(docs), "minhash-profiles")
    nodes = staged(rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key")
                   .agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n")),
                   "minhash-nodes")
    keyed = bucket_rows(nodes)
    shared = (keyed.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("last"))
              .filter("center < last").select("key", "center"))
    buckets = staged(keyed.join(shared, "key"), "minhash-buckets")
    release(spark)
    sets = staged(full_sets(docs, buckets.select("node").distinct()), "minhash-sets")
    release(spark)
    first = buckets.filter("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    first = staged(plausible(first, nodes, similarity), "minhash-pairs")
    links = staged(confirmed(first, sets, similarity), "minhash-links")
    release(spark)
    found = components(links)

    # round two: members of one bucket that are still in different components
    placed = buckets.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("c"))
    open_keys = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("key")
    open_nodes = staged(placed.join(open_keys, "key", "left_semi").select("node", "c").distinct(), "minhash-open")
    rare = prefix_rows(sets.join(open_nodes.select("node"), "node", "left_semi"), similarity)
    rare = rare.join(open_nodes, "node").join(nodes.groupBy("node").agg(F.max("n").alias("n")), "node")
    split = rare.groupBy("shingle").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("shingle")
    rare = staged(rare.join(split, "shingle", "left_semi"), "minhash-rare")
    other = rare.select("shingle", F.col("node").alias("b"), F.col("c").alias("cb"), F.col("n").alias("nb"), F.col("pos").alias("posb"))
    # at the rarest common shingle all that is common still lies ahead, and must be enough
    ahead = F.least(F.col("n") - F.col("pos"), F.col("nb") - F.col("posb"))
    apart = (F.col("a") < F.col("b")) & (F.col("c") != F.col("cb")) & (ahead * (100 + similarity) >= (F.col("n") + F.col("nb")) * similarity)
    second = rare.withColumnRenamed("node", "a").join(other, "shingle").filter(apart).select("a", "b").distinct()
    second = staged(plausible(second, nodes, similarity), "minhash-pairs")
    release(spark)
    if second.take(1):
        links = staged(confirmed(second, sets, similarity).unionAll(links), "minhash-links")
        release(spark)
        found = components(links)
    names = nodes.join(found, "node", "left").select("set_key", F.coalesce("component", "node").alias("c"))
    out = rows.select("doc_id", "n_shingles", "set_key").join(names, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with _n: a number of its own for every (doc_id, text), in the order of ids, null ids last.

    Only ids and hashes of texts are sorted.
    """
    text = F.col("text").cast("string")
    hashed = docs.withColumns({"_x": F.xxhash64(text), "_y": F.xxhash64(F.lit(1), text, text.isNull())})
    pairs = hashed.select(F.col("doc_id").cast("long").alias("_i"), "_x", "_y").distinct()
    numbers = pairs.orderBy(F.asc_nulls_last("_i"), "_x", "_y").withColumn("_n", F.monotonically_increasing_id())
    numbers = staged(numbers, "minhash-numbers").select("_i", F.col("_x").alias("_x2"), F.col("_y").alias("_y2"), "_n")
    same = hashed["doc_id"].cast("long").eqNullSafe(numbers["_i"]) & (hashed["_x"] == numbers["_x2"]) & (hashed["_y"] == numbers["_y2"])
    return hashed.join(numbers, same).drop("_x", "_y", "_i", "_x2", "_y2")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row per group of near-duplicates, with the columns of ``docs``.

    Of rows with equal doc_id and text, one stays.  Rows that repeat a doc_id
    with other texts, and rows without a doc_id, are judged each by their own
    text: they compete under a number of their own, rows without a doc_id
    last.  Of rows without a doc_id those without a word go.
    """
    text = F.col("text").cast("string")
    odd = (docs.groupBy(F.col("doc_id").cast("long").alias("_i"))
           .agg(F.min(F.xxhash64(text)).alias("lo"), F.max(F.xxhash64(text)).alias("hi")).filter("_i IS NULL OR lo <> hi"))
    if not odd.take(1):
        kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_kept")).distinct()
        return docs.join(kept, docs["doc_id"] == kept["_kept"], "left_semi").dropDuplicates(["doc_id"])
    rows = staged(_numbered(docs), "minhash-numbered")
    found = near_duplicates(rows.select(F.col("_n").alias("doc_id"), "text")).filter("kept")
    kept = found.select(F.col("doc_id").alias("_m"), (F.col("n_shingles") > 0).alias("_has_words")).distinct()
    out = rows.join(kept, rows["_n"] == kept["_m"]).filter(F.col("doc_id").isNotNull() | F.col("_has_words"))
    return out.dropDuplicates(["_n"]).select(*[rows[c] for c in docs.columns])
