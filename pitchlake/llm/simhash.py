"""Near-duplicates by SimHash, links found with multi-index hashing.

A fingerprint has bit j set if more than half of a text's shingle hashes have
it.  Two fingerprints link if ``RADIUS`` = 2 bits or fewer differ.  They are
indexed by their two 32-bit segments; by the pigeonhole principle one of three
probes finds every link, and each link is found by one of them only:

- the high segments are equal (then 2 bits of the low ones may differ);
- they differ in one bit (1 bit of the low ones): the Hamming ball of radius 1
  round the high segment is enumerated.  One of the two segments has an even
  number of set bits, so only such segments send out their ball;
- they differ in two bits: then the low segments are equal.

What a probe fetches is verified on all 64 bits within the join.  Equal
fingerprints are one node, so copies are never paired.  Members of
a segment value that more than ``HOT`` different fingerprints share do not all
meet: they are indexed once more by the 16-bit halves of their other segment,
with balls of radius 1 again, so the work on them stays near linear.

Classes are the components of all links; a class has the least doc_id of its
documents.  Fingerprints are made in tasks with numpy, chunk by chunk; from
then on rows are a doc_id and 8 bytes.

Edge cases: null and empty texts, and texts of breaks only, have the
fingerprint 0 and are linked like any other.  Repeated rows are all returned.
Rows without a doc_id belong to the class of their text, but never name it; a
class of such rows alone has a null component_id.  An empty table gives an
empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pitchlake.llm.common import release, staged
from pitchlake.llm.graph import components

# Fixed by the result contract.
WIDTH = 3
SEED = 42
RADIUS = 2
#: Members of a segment value that are met directly.
HOT = 256
#: Shingle hashes whose bits are counted at a time.
CHUNK = 1 << 14


def shingle_hashes(text: str | None) -> Iterator[np.ndarray]:
    """The hashes of all shingles of a text, ``CHUNK`` at a time."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()      # both are ASCII's on bytes
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    width = min(WIDTH, len(words))
    starts, ends = starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    for k in range(0, len(starts), CHUNK):
        some = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[k:k + CHUNK], ends[k:k + CHUNK], strict=True)]
        yield np.array(some, "<u8")


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text (0 without words)."""
    total, ones = 0, np.zeros(64, np.int64)
    for h in shingle_hashes(text):
        total += len(h)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) of every row."""
    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = np.array([fingerprint(t) for t in pdf["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "fp": fp})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInPandas(part, "doc_id long, fp long")


def high(x: Column) -> Column:
    return F.shiftrightunsigned(x, 32)


def low(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << 32) - 1))


def ball(segment: Column, bits: int) -> Column:
    """All values that differ from a segment of ``bits`` bits in one bit."""
    return F.transform(F.lit([1 << j for j in range(bits)]).cast("array<long>"), lambda one: segment.bitwiseXOR(one))


def by_halves(rows: DataFrame, rest: Column, asks: bool) -> DataFrame:
    """at, sub, x: keys of the second index, on the halves of the 32 bits of ``rest``.

    At most two of them differ, so the first halves differ in one bit or
    fewer (the side that asks sends out their ball) or the second are equal.
    """
    one, two = F.shiftrightunsigned(rest, 16), rest.bitwiseAND(F.lit((1 << 16) - 1))
    first = F.concat(F.array(one), ball(one, 16)) if asks else F.array(one)
    keys = F.concat(F.transform(first, lambda v: 2 * v), F.array(2 * two + 1))
    return rows.select("at", F.explode(keys).alias("sub"), "x")


def verified(asking: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """a, b: rows that meet and differ in ``RADIUS`` bits or fewer, each pair in one order only."""
    a, b = asking.withColumnRenamed("x", "a").alias("l"), table.withColumnRenamed("x", "b").alias("r")
    same = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in on]
    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS) & (F.col("a") != F.col("b"))
    found = a.join(b, [*same, near]).select("a", "b")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def links(nodes: DataFrame) -> DataFrame:
    """a, b: all pairs of fingerprints (column fp, each once) that link."""
    x = nodes.select(F.col("fp").alias("x"))
    even = F.bit_count(high(F.col("x"))) % 2 == 0
    by_high, by_low = (x.select(f(F.col("x")).alias("at"), "x") for f in (high, low))
    balls = x.filter(even).select(F.explode(ball(high(F.col("x")), 32)).alias("at"), "x")
    probes = [(by_high, by_high, low), (balls, by_high.filter(~even), low), (by_low, by_low, high)]
    crowds = [t.groupBy("at").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select(F.lit(k).alias("k"), "at")
              for k, (_, t, _) in enumerate(probes)]
    crowded = staged(crowds[0].unionAll(crowds[1]).unionAll(crowds[2]), "simhash-crowded")
    any_crowd = bool(crowded.take(1))
    found = []
    for k, (asking, t, rest) in enumerate(probes):
        if any_crowd:
            hot = crowded.filter(F.col("k") == k).select("at")
            found.append(verified(*(by_halves(side.join(hot, "at", "left_semi"), rest(F.col("x")), asks)
                                    for side, asks in ((asking, True), (t, False))), ["at", "sub"]))
            asking, t = (side.join(hot, "at", "left_anti") for side in (asking, t))
        found.append(verified(asking, t, ["at"]))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out.distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id of every row of ``docs``."""
    rows = staged(fingerprints(docs), "simhash-rows")
    nodes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    found = components(staged(links(nodes), "simhash-links"), "simhash-components")
    release(docs.sparkSession)
    members = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("c"))
    classes = members.groupBy("c").agg(F.min("least").alias("component_id"))
    named = members.join(classes, "c").select(F.col("fp").alias("key"), "component_id")
    out = rows.join(named, rows["fp"] == named["key"], "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
