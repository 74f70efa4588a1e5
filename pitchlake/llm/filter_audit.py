"""Filter interaction audit: what every filter removes, under every order.

Each document gets a mask with one bit per filter that it fails.  Documents
of a part with equal masks are one weighted cell, so at most 32 cells of a
part remain whatever the input.  One fold over a part's cells does the rest:

1. A cell folds across the array of all 120 orders, a constant of the plan:
   along an order the filters seen so far are kept as a mask, and each of the
   five steps yields one struct of weighted counts (600 structs a cell).
2. The structs of all cells are merged by elementwise sums.
3. Of the merged structs the removals of each filter are summed over all
   orders (``shapley``), and the 600 structs become rows.

Whether a text stands under a smaller doc_id is decided without gathering the
copies of a text: the least doc_id of each text's SHA-256 comes from map-side
minima, and a row is the first of its text if its (doc_id, digest) is in that
list.  That join has no hot key, however many copies a text has.

Texts are read once; the narrow facts are written to the shared folder.

Edge cases: null and empty texts fail A and, beyond the first, E.  A row
without a doc_id has no smaller doc_id: it never fails E, nor makes another
fail; its labels are unknown.  Rows that repeat a doc_id count one by one;
equal ids are not smaller.  Of several labels of a doc_id any 1 counts.  Null
and empty sources are one part.  An empty table gives no rows.  Only doc_id,
text, source and the labels' doc_id, quality and toxic are read.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import staged, text_or_empty, words

# Fixed by the result contract.
FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 2
SYMBOLS = "[#$%&*|]"

BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    text = text_or_empty(text)
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    # one element, so that the words are split once and the lambda names them
    seen = F.struct(words(text).alias("w"), upper.cast("long").alias("upper"), F.length(text).cast("long").alias("chars"))
    fails = F.transform(F.array(seen), lambda x: (
        F.when(F.size(x["w"]) < MIN_WORDS, BIT["A"]).otherwise(0)
        + F.when(100 * F.size(F.array_distinct(x["w"])).cast("long") < MIN_DISTINCT_PERCENT * F.size(x["w"]).cast("long"),
                 BIT["B"]).otherwise(0)
        + F.when(100 * x["upper"] > MAX_UPPER_PERCENT * x["chars"], BIT["C"]).otherwise(0)))
    return F.get(fails, F.lit(0)) + F.when(text.rlike(SYMBOLS), BIT["D"]).otherwise(0)


def facts(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text and mask of the filters A to D of every row."""
    text = text_or_empty(F.col("text").cast("string"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text_mask(text).alias("mask"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, and the number of documents, of good and of toxic ones: 32 rows a part at most."""
    rows = staged(facts(docs), "audit-facts")
    first = (rows.filter("doc_id IS NOT NULL").groupBy(F.col("digest").alias("first_digest"))
             .agg(F.min("doc_id").alias("first_id")))
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    rows = (rows.join(first, (F.col("doc_id") == F.col("first_id")) & (F.col("digest") == F.col("first_digest")), "left")
            .join(marks, F.col("doc_id") == F.col("label_id"), "left"))
    later = F.col("doc_id").isNotNull() & F.col("first_id").isNull()
    return (rows.groupBy("part", (F.col("mask") + F.when(later, BIT["E"]).otherwise(0)).alias("mask"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
                 F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")))


def constant(value: list, kind: str) -> Column:
    """A nested constant (folded before the plan runs)."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _step(cell: Column, before: Column, bit: Column) -> Column:
    """Weighted counts of a cell at a step: ``before`` has the filters of the earlier steps."""
    mask, none = cell["mask"], F.lit(0).cast("long")
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0
    here = fails & ~gone
    return F.struct(
        F.when(~fails & ~gone, cell["n"]).otherwise(none).alias("kept"), F.when(here, cell["n"]).otherwise(none).alias("removed"),
        F.when(fails & gone, cell["n"]).otherwise(none).alias("redundant"), F.when(mask == bit, cell["n"]).otherwise(none).alias("unique_fails"),
        F.when(here, cell["good"]).otherwise(none).alias("good_lost"), F.when(here, cell["toxic"]).otherwise(none).alias("toxic_lost"))


def _fold(cell: Column, orders: Column) -> Column:
    """The 600 structs of one cell."""
    kind = "array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(0).alias("before"), F.array().cast(kind).alias("steps"))

    def along(order: Column) -> Column:
        return F.aggregate(
            order, start,
            lambda acc, bit: F.struct(acc["before"].bitwiseOR(bit).alias("before"),
                                      F.concat(acc["steps"], F.array(_step(cell, acc["before"], bit))).alias("steps")),
            lambda acc: acc["steps"])
    return F.flatten(F.transform(orders, along))


def tables(cells_of_part: Column) -> Column:
    """The merged structs of a part's cells, with the sums over all orders."""
    zero = F.lit(0).cast("long")
    orders = constant([[BIT[f] for f in o] for o in ORDERS], "array<array<int>>")
    keys = constant([{"filter_order": o, "step": i + 1, "filter": f} for o in ORDERS for i, f in enumerate(o)],
                    "array<struct<filter_order:string,step:int,filter:string>>")
    zeros = F.array_repeat(F.struct(*[zero.alias(c) for c in COUNTS]), len(ORDERS) * len(FILTERS))
    merged = F.aggregate(
        cells_of_part, zeros,
        lambda acc, cell: F.zip_with(acc, _fold(cell, orders),
                                     lambda a, b: F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])))
    # one-element arrays name a step, so that it is not built anew for each use
    rows = F.transform(F.array(merged), lambda m: F.zip_with(m, keys, lambda x, k: F.struct(x.alias("x"), k.alias("k"))))
    total = lambda r, f: F.aggregate(r, zero, lambda n, x: n + F.when(x["k"]["filter"] == f, x["x"]["removed"]).otherwise(zero))
    summed = F.transform(rows, lambda r: F.struct(r.alias("rows"), F.create_map(*[c for f in FILTERS for c in (F.lit(f), total(r, f))]).alias("sums")))
    return F.get(F.transform(summed, lambda s: F.transform(s["rows"], lambda x: F.struct(
        x["k"].alias("k"), x["x"].alias("x"), s["sums"][x["k"]["filter"]].alias("shapley")))), F.lit(0))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    parts = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    rows = parts.select("part", F.explode(tables(F.col("cells"))).alias("r"))
    return rows.select("part", "r.k.filter_order", "r.k.step", "r.k.filter", *[f"r.x.{c}" for c in COUNTS], "r.shapley")
