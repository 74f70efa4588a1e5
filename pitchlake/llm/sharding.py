"""Sharding by a hierarchical weighted hash tree.

A tree has regions, regions have racks, racks have shards; every shard has a
weight, and a rack or region weighs what its shards weigh together.  Each key
has one exponential clock per shard, ``-ln(u) / weight`` with ``u`` a hash
draw of (shard, key).  A node's draw is the earliest clock under it: the
minimum of exponential clocks is again an exponential clock whose rate is the
sum of the rates, so at every level the key picks a node with probability
proportional to the node's weight.  The descent takes the earliest region,
then the earliest rack in it, then the earliest shard in that.

Raising a weight or adding a shard only makes clocks under that node earlier.
So a key moves only if a changed clock wins, and then only into the changed
shard; keys never move between shards whose weights stay as they are.

The hash draw uses the first 13 hex digits (52 bits) of an md5, which is the
same in every engine and session.  The tree is a parameter (a few hundred
shards), never data, and the plan is a projection: placing rows needs no
shuffle.  Only ``slot`` (a gapless position in the shard) shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import text_or_empty, utf8_bytes

#: Rows are numbered in blocks of this many ids, so no window holds a whole shard.
SLOT_BLOCK = 1 << 14


@dataclass(frozen=True)
class Shard:
    """One leaf of the tree."""

    shard: int
    region: str
    rack: str
    weight: float = 1.0


def even_tree(n: int, regions: int = 2, racks: int = 2) -> list[Shard]:
    """``n`` shards of weight 1 dealt over ``regions`` x ``racks``.

    Shard ``i`` has the same place for every ``n``, so ``even_tree(n + 1)`` is
    ``even_tree(n)`` plus one shard.
    """
    return [Shard(i, f"g{i % regions}", f"k{i // regions % racks}") for i in range(n)]


def _clock(key: Column, leaf: Shard) -> Column:
    """The key's exponential clock at a leaf (weight 0: never)."""
    if leaf.weight <= 0:
        return F.lit(float("inf"))
    digits = F.substring(F.md5(F.concat(F.lit(f"{leaf.shard}/"), key).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(float(leaf.weight))


def with_shard(rows: DataFrame, key: Column, tree: list[Shard], name: str) -> DataFrame:
    """Add the shard of a text key: descend region, rack and shard by earliest clock.

    Equal clocks (a chance of 2^-52) go to the lower region, rack and shard.
    The clocks are columns, so they are drawn once per row, and the descent is
    a nested CASE over them.
    """
    if not tree:
        raise ValueError("the tree has no shard")
    if len({leaf.shard for leaf in tree}) < len(tree):
        raise ValueError("a shard may stand in the tree once only")
    clock = {leaf: f"_clock{leaf.shard}" for leaf in tree}
    rows = rows.withColumns({c: _clock(key, leaf) for leaf, c in clock.items()})

    def descend(leaves: list[Shard], levels: tuple[str, ...]) -> Column:
        """The shard under the node of this level whose draw is the earliest."""
        if not levels:
            return F.lit(leaves[0].shard)
        nodes: dict = {}
        for leaf in sorted(leaves, key=lambda x: getattr(x, levels[0])):
            nodes.setdefault(getattr(leaf, levels[0]), []).append(leaf)
        draws = [_least([F.col(clock[x]) for x in under]) for under in nodes.values()]
        first = _least(draws)
        below = [descend(under, levels[1:]) for under in nodes.values()]
        return F.coalesce(*[F.when(d == first, x) for d, x in zip(draws, below, strict=True)])

    return rows.withColumn(name, descend(tree, ("region", "rack", "shard"))).drop(*clock.values())


def _least(columns: list[Column]) -> Column:
    return F.least(*columns) if len(columns) > 1 else columns[0]


def assign_shards(docs: DataFrame, tree: list[Shard], grown: list[Shard] | None = None) -> DataFrame:
    """Place every row of ``docs`` (doc_id, text) by its doc_id.

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, shard,
    slot and grown_shard (the shard under ``grown``, else null).

    Rows that repeat a doc_id go to one shard and get a slot each.  A null
    doc_id is a key of its own (the empty text), a null text counts as empty.
    Other columns, whatever their names, are not read.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select("doc_id", (utf8_bytes(F.col("text")) + 1).alias("size"),
                       F.crc32(text_or_empty(F.col("text")).cast("binary")).alias("text_crc32"))
    rows = with_shard(rows, key, tree, "shard")
    rows = with_shard(rows, key, grown, "grown_shard") if grown else \
        rows.withColumn("grown_shard", F.lit(None).cast("int"))
    return with_slots(rows)


def with_slots(placed: DataFrame) -> DataFrame:
    """Gapless slots from 0 per shard, in order of doc_id (null first), text_crc32, size.

    Rows are numbered inside (shard, block of ids); a second, small frame of
    one row per block carries the number of rows before the block.
    """
    block = F.floor(F.col("doc_id") / F.lit(SLOT_BLOCK))
    rows = placed.withColumn("_block", F.coalesce(block, F.lit(-(1 << 62))))
    order = (F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    counts = rows.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("shard", "_block", (F.sum("_n").over(
        Window.partitionBy("shard").orderBy("_block")) - F.col("_n")).alias("_before"))
    local = F.row_number().over(Window.partitionBy("shard", "_block").orderBy(*order))
    return (rows.withColumn("_local", local).join(before, ["shard", "_block"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("_before") + F.col("_local") - 1).alias("slot"), "grown_shard"))
