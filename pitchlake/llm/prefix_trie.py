"""Conversation prefix trie by ROLLUP over positional turn columns.

Conversations are rebuilt (see :func:`rebuilt`), and every distinct sequence of
first turns is a node.  The turns of a conversation are laid out in blocks of
``WIDTH`` columns.  One ``GROUP BY block, prior node, ROLLUP(turn 1, ...,
turn WIDTH)`` aggregates all prefixes of all conversations together; how many
columns ``grouping_id`` leaves is the depth within the block.  A long
conversation continues in further blocks, each keyed by the node at which the
block before ended, so its cost follows its length, not the square of it, and
no step waits for another block.

A turn column holds 128 bits of the SHA-256 of the turn's place, role and
text.  A node's key is the XOR of the columns on its path: taking the last
one off gives the parent's key, and the key before any block is a running XOR
that can be summed in slices, so no window holds a whole conversation.

Every node belongs to its smallest member, and the nodes of one member are a
path.  Subtree sums follow from that without a walk over levels: a second
ROLLUP adds up, over the members of a node, what each owns on its whole path,
and what the owner has above the node is taken off.

Turns get their positions from one global order (range partitions and their
row counts), so a conversation that holds a third of all rows is spread over
many tasks.  The SHA-256 of member lists runs over pieces that are joined
where the rows lie; it keeps one state, whatever the list's length.

Edge cases: null roles and texts are empty.  Turns that tie are ordered by the
SHA-256 of role and text; null turns come first.  Rows without a conv_id
belong to no conversation.  Repeated rows are turns of their own.  An empty
table gives no nodes.  Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import release, staged, text_or_empty, words

#: Turn columns of a block.
WIDTH = 4
#: Rows of a conversation that one window holds.
SLICE = 1 << 12
#: Members whose ids are joined to one piece of text.
PIECE = 512

# Fixed by the result contract.
GROUP = 20
HEADS = 4

KEY = ("depth", "ka", "kb")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest of role and text, n_words of every row with a conv_id."""
    role, text = (text_or_empty(F.col(c).cast("string")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.sha2(whole.cast("binary"), 256).alias("digest"), F.size(words(text)).cast("long").alias("n_words"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` in the order of conversations and turns, with the gapless number ``g``."""
    rows = staged(rows, "trie-turns")              # the sort looks at its input twice
    ordered = staged(rows.orderBy("conv_id", F.asc_nulls_first("turn"), "digest")
                     .withColumn("m", F.monotonically_increasing_id()), "trie-ordered")
    part = F.shiftright("m", 33)
    # one row per partition of the sort
    counts = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    return (ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
            .withColumn("g", F.col("offset") + F.col("m").bitwiseAND(F.lit((1 << 33) - 1))).drop("m", "part", "offset", "turn"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest, n_words: the turns of the rebuilt conversations, and a row with a null pos for each.

    Conversation c takes its first h turns from conversation c - c % 20, and
    its own turns after its first h; h is crc32 of the decimal c, modulo 4.
    """
    rows = numbered(turns(conversations))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = rows.groupBy("conv_id").agg(F.min("g").alias("first"), F.count(F.lit(1)).alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    bases = convs.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = staged(convs.withColumns({"h": h, "base": base}).join(bases, "base", "left")
                   .withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))), "trie-convs")
    pos = F.col("g") - F.col("first") + 1
    placed = rows.join(convs.select("conv_id", "first", "h", "taken"), "conv_id").withColumn("pos", pos)
    own = placed.filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "n_words")
    heads = placed.filter((F.col("conv_id") % GROUP == 0) & (F.col("pos") < HEADS)).select(
        F.col("conv_id").alias("base"), "pos", "digest", "n_words")
    heads = heads.join(convs.select("conv_id", "base", "h"), "base").filter("pos <= h").select("conv_id", "pos", "digest", "n_words")
    none = convs.select("conv_id", F.lit(None).cast("long"), F.lit(None).cast("string"), F.lit(0).cast("long"))
    return own.unionAll(heads).unionAll(none)


def before(rows: DataFrame, place: str, values: list[str], add) -> DataFrame:
    """``rows`` with, for each of ``values``, the ``add`` of the rows of its conv_id at smaller places (``*_before``).

    Runs within slices of ``SLICE`` places, and over the sums of slices.
    """
    rows = rows.withColumn("_slice", F.floor(F.col(place) / SLICE).cast("long"))
    inside = Window.partitionBy("conv_id", "_slice").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("conv_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "_slice").agg(*[add(v).alias(f"_s_{v}") for v in values])
    # first slices have nothing before them
    sums = sums.select("conv_id", "_slice", *[add(f"_s_{v}").over(across).alias(f"_s_{v}") for v in values]).filter("_slice > 0")
    rows = rows.withColumns({f"_i_{v}": add(v).over(inside) for v in values}).join(sums, ["conv_id", "_slice"], "left")
    join = Column.bitwiseXOR if add is F.bit_xor else Column.__add__
    zero = F.lit(0).cast("long")
    joined = {f"{v}_before": join(F.coalesce(f"_i_{v}", zero), F.coalesce(f"_s_{v}", zero)) for v in values}
    return rows.withColumns(joined).drop("_slice", *[f"_{x}_{v}" for v in values for x in "is"])


def blocks(seq: DataFrame) -> DataFrame:
    """conv_id, block, a1, b1, n1, ..., and the key (pa, pb) of the node at which the block before ended.

    a_i and b_i are 128 bits of the i-th turn's place, role and text, n_i its
    words; they are null from the conversation's end on.
    """
    mark = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("digest")).cast("binary"), 256)
    half = lambda k: F.conv(F.substring(mark, k, 16), 16, -10).cast("long")
    at = seq.select("conv_id", "pos", "n_words", half(1).alias("a"), half(17).alias("b"),
                    F.coalesce(F.floor((F.col("pos") - 1) / WIDTH), F.lit(0)).cast("long").alias("block"),
                    ((F.col("pos") - 1) % WIDTH + 1).alias("slot"))
    columns = [F.max(F.when(F.col("slot") == i, F.col(c))).alias(f"{to}{i}")
               for i in range(1, WIDTH + 1) for c, to in (("a", "a"), ("b", "b"), ("n_words", "n"))]
    rows = at.groupBy("conv_id", "block").agg(*columns, F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"), F.count("pos").alias("n_turns"))
    rows = before(rows, "block", ["xa", "xb"], F.bit_xor)
    return rows.withColumnsRenamed({"xa_before": "pa", "xb_before": "pb"})


def prefixes(rows: DataFrame, sums: str) -> DataFrame:
    """One row per node: depth, key (ka, kb), the last turn (a, b, n_words), and ``sums`` over its members."""
    cols = [f"(a{i}, b{i}, n{i})" for i in range(1, WIDTH + 1)]
    names = [f"{c}{i}" for i in range(1, WIDTH + 1) for c in "abn"]
    out = rows.sparkSession.sql(
        f"SELECT block, pa, pb, grouping_id() AS gid, {', '.join(names)}, {sums} FROM {{rows}} "
        f"GROUP BY block, pa, pb, ROLLUP({', '.join(cols)})", rows=rows)
    level = F.lit(WIDTH) - F.bit_count("gid") / 3
    last = lambda c: F.get(F.array(*[F.col(f"{c}{i}") for i in range(1, WIDTH + 1)]), (F.col("level") - 1).cast("int"))

    def key(c: str) -> Column:
        out = F.col(f"p{c}")
        for i in range(1, WIDTH + 1):
            out = out.bitwiseXOR(F.coalesce(f"{c}{i}", F.lit(0).cast("long")))
        return out
    out = out.withColumn("level", level.cast("int")).withColumns({"a": last("a"), "b": last("b"), "n_words": F.coalesce(last("n"), F.lit(0).cast("long"))})
    # a prefix beyond a conversation's end is no node; a later block's own level 0 is the node before it
    out = out.filter("a IS NOT NULL OR (level = 0 AND block = 0)")
    out = out.withColumns({"depth": F.col("block") * WIDTH + F.col("level"), "ka": key("a"), "kb": key("b")})
    return out.drop("block", "pa", "pb", "gid", "level", *names)


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Join the ids of neighbouring rows of one node, ``PIECE`` at most."""
    for pdf in batches:
        run = (pdf[list(KEY)] != pdf[list(KEY)].shift()).any(axis=1).cumsum()
        piece = pdf.groupby(run).cumcount() // PIECE
        ids = pdf["conv_id"].astype(str)
        out = pdf.assign(ids=ids).groupby([run, piece], sort=False).agg(
            **{k: (k, "first") for k in KEY}, first=("conv_id", "first"), ids=("ids", ",".join))
        yield out.reset_index(drop=True)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's pieces, which come in order; one state is held."""
    key, state = None, None
    for pdf in batches:
        done = []
        for *now, ids in zip(*(pdf[k] for k in KEY), pdf["ids"], strict=True):
            if now != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = now, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield pd.DataFrame(done, columns=[*KEY, "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=[*KEY, "ends_sha256"])


def ends(rows: DataFrame) -> DataFrame:
    """Key and ends_sha256 of every node at which a conversation ends."""
    last = rows.groupBy("conv_id").agg(F.sum("n_turns").cast("long").alias("depth"), F.coalesce(F.bit_xor("xa"), F.lit(0).cast("long")).alias("ka"),
                                       F.coalesce(F.bit_xor("xb"), F.lit(0).cast("long")).alias("kb"))
    kind = "depth long, ka long, kb long"
    spread = last.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").select(*KEY, "conv_id")
    pieces = spread.mapInPandas(_pieces, f"{kind}, first long, ids string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInPandas(_digests, f"{kind}, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = staged(blocks(rebuilt(conversations)), "trie-blocks")
    release(conversations.sparkSession)
    nodes = prefixes(rows, "count(*) AS n_convs, min(conv_id) AS conv_id")
    nodes = staged(nodes.select(*KEY, "conv_id", "n_convs", F.col("a").bitwiseXOR(F.col("ka")).alias("qa"),
                                F.col("b").bitwiseXOR(F.col("kb")).alias("qb"),
                                ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved")), "trie-nodes")
    up = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("qa").alias("ka"), F.col("qb").alias("kb")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(up, list(KEY), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = staged(before(nodes, "depth", ["saved"], F.sum), "trie-children")
    owned = nodes.groupBy("conv_id").agg(F.sum("saved").alias("all_saved"), F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf"))
    below = prefixes(rows.join(owned, "conv_id", "left"), "sum(coalesce(all_saved, 0)) AS all_saved, sum(coalesce(leaf, 0)) AS n_leaves") \
        .select(*KEY, "all_saved", "n_leaves")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("ka").alias("qa"), F.col("kb").alias("qb"),
                           F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(below, list(KEY)).join(ends(rows), list(KEY), "left").join(parents, ["depth", "qa", "qb"], "left")
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
                      F.col("n_leaves").cast("long").alias("n_leaves"), (F.col("all_saved") - F.col("saved_before")).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
