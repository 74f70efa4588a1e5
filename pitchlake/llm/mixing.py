"""Mixing overlapping sources to target weights by min-cost flow.

1. Documents are aggregated by membership pattern (the set of sources that a
   document belongs to): rows and words per pattern.
2. Words flow from patterns to the quotas of the sources they belong to.  The
   first use of a word is free, each further use costs one more (convex), up
   to ``max_uses``.  The flow is found by shortest augmenting paths on the
   aggregate -- one node per pattern and source, never a row per document.
3. Inside each (pattern, source) the flow becomes whole documents: every
   document gets the whole uses, and the rest goes to documents in the order
   of a seeded hash while the running sum of their sizes fits.

The running sum is taken inside (pattern, hash block) on top of the sums of
the blocks before, so a source with a third of all rows is spread over
``16 ** BLOCK_DIGITS`` windows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import staged, words

BLOCK_DIGITS = 3

#: Weights of the sources in code point order (null last), repeating.
WEIGHTS = (5, 2, 1)
#: All targets together, as a share of all sizes.
SHARE = 1.5
#: Uses of a document, at most.
MAX_USES = 2


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share: float = SHARE,
            max_uses: int = MAX_USES) -> dict[str | None, float]:
    """Target words per source.

    The total is dealt by weight; a target above ``max_uses`` times its
    source's size stops there, and the excess is dealt again by weight until
    none is above.
    """
    order = sorted((s for s, _ in sizes if s is not None)) + [None] * any(s is None for s, _ in sizes)
    size = dict(sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, total = order, sum(size.values()) * share
    out: dict[str | None, float] = {}
    while left:
        rate = (total - sum(out.values())) / sum(weight[s] for s in left)
        full = [s for s in left if weight[s] * rate > max_uses * size[s]]
        if not full:
            return out | {s: weight[s] * rate for s in left}
        out |= {s: float(max_uses * size[s]) for s in full}
        left = [s for s in left if s not in out]
    return out


def min_cost_flow(capacity: list[int], members: list[list[int]], quotas: list[int],
                  max_uses: int = MAX_USES) -> list[dict[int, int]]:
    """Words that each pattern sends to each of its sources.

    ``capacity[p]`` words of pattern ``p`` may be used ``max_uses`` times; the
    k-th use of a word costs ``k - 1``.  Returns per pattern {source: words}.
    As much of the quotas is filled as can be, at the least total cost
    (successive shortest paths on the residual graph).
    """
    n_pat, n_src = len(capacity), len(quotas)
    start, end = n_pat + n_src, n_pat + n_src + 1
    graph: list[list[list]] = [[] for _ in range(end + 1)]

    def edge(a: int, b: int, cap: int, cost: int) -> list:
        there, back = [b, cap, cost, None], [a, 0, -cost, None]
        there[3], back[3] = back, there
        graph[a].append(there)
        graph[b].append(back)
        return there

    for p in range(n_pat):
        for use in range(max_uses):
            edge(start, p, capacity[p], use)
    route = [{s: edge(p, n_pat + s, max_uses * capacity[p], 0) for s in members[p]} for p in range(n_pat)]
    for s in range(n_src):
        edge(n_pat + s, end, quotas[s], 0)
    lift = [0] * (end + 1)             # potentials keep reduced costs non-negative
    while True:
        dist: list[float] = [float("inf")] * (end + 1)
        came: list = [None] * (end + 1)
        dist[start], heap = 0, [(0, start)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > dist[a]:
                continue
            for e in graph[a]:
                if e[1] > 0 and (x := d + e[2] + lift[a] - lift[e[0]]) < dist[e[0]]:
                    dist[e[0]], came[e[0]] = x, e
                    heapq.heappush(heap, (x, e[0]))
        if came[end] is None:
            break
        lift = [x + int(d) if d < float("inf") else x for x, d in zip(lift, dist, strict=True)]
        path, at = [], end
        while at != start:
            path.append(came[at])
            at = came[at][3][0]
        amount = min(e[1] for e in path)
        for e in path:
            e[1] -= amount
            e[3][1] += amount
    return [{s: e[3][1] for s, e in r.items() if e[3][1]} for r in route]


def seeded(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def mix(docs: DataFrame, size: Column, sources: Column, seed: str = "mix", weights=WEIGHTS,
        share: float = SHARE, max_uses: int = MAX_USES, carry: tuple[str, ...] = ()) -> DataFrame:
    """Choose how often each document is used so that sources meet their targets.

    ``sources`` is an array of source names (null is a name).  Returns
    doc_id, size, sources, source_size and target (both of the first source),
    taken (words, repeats counted), copies, and the ``carry`` columns as
    ``carried_<name>``.

    Rows that repeat a doc_id are documents of their own (in hash order they
    stand together).  Empty texts have size 0 and follow their pattern's whole
    uses.  An empty table gives an empty result.  The seed and the ids decide:
    reruns agree.
    """
    spark = docs.sparkSession
    full = docs.select("doc_id", size.cast("long").alias("size"), sources.alias("sources"),
                       seeded(F.col("doc_id"), seed).alias("_h"), *[F.col(c).alias(f"_carry_{c}") for c in carry])
    # a narrow table for the sums; texts are read again only where they are carried
    rows = staged(full.select("doc_id", "size", "sources", "_h"), "mix")
    agg = rows.groupBy("sources").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    names = sorted({s for r in agg for s in r["sources"] if s is not None})
    names = names + [None] * any(s is None for r in agg for s in r["sources"])
    at = {s: i for i, s in enumerate(names)}
    src_size = {s: sum(r["size"] for r in agg if s in r["sources"]) for s in names}
    own = {s: sum(r["size"] for r in agg if r["sources"][0] == s) for s in names}
    goal = targets(list(own.items()), weights, share, max_uses)
    flows = min_cost_flow([r["size"] for r in agg], [[at[s] for s in r["sources"]] for r in agg],
                          [int(goal[s]) for s in names], max_uses)
    plan = []
    for r, flow in zip(agg, flows, strict=True):
        used = sum(flow.values())
        whole = used // r["size"] if r["size"] else 0
        first = r["sources"][0]
        plan.append((r["sources"], int(whole), int(used - whole * r["size"]), int(src_size[first]), float(goal[first])))
    plan_df = spark.createDataFrame(plan, "sources array<string>, _whole long, _rest long, source_size long, target double")
    # one row per pattern; patterns are bounded by the sources' overlaps, not by the documents
    block = F.substring("_h", 1, BLOCK_DIGITS)
    rows, full = (x.withColumns({"_b": block, "_s": F.to_json("sources", {"ignoreNullFields": "false"})})
                  for x in (rows, full if carry else rows))
    plan_df = plan_df.withColumn("_s", F.to_json("sources", {"ignoreNullFields": "false"})).drop("sources")
    sums = rows.groupBy("_s", "_b").agg(F.sum("size").alias("_n"))
    before = sums.select("_s", "_b", (F.sum("_n").over(Window.partitionBy("_s").orderBy("_b"))
                                      - F.col("_n")).alias("_before"))
    inside = Window.partitionBy("_s", "_b").orderBy("_h", "size").rowsBetween(Window.unboundedPreceding, 0)
    out = (full.withColumn("_run", F.sum("size").over(inside))
           .join(before.join(plan_df, "_s"), ["_s", "_b"]))
    middle = 2 * (F.col("_before") + F.col("_run")) - F.col("size")
    copies = F.col("_whole") + (middle <= 2 * F.col("_rest")).cast("long")
    return out.select("doc_id", "size", "sources", "source_size", "target",
                      (F.col("size") * F.least(copies, F.lit(max_uses).cast("long"))).alias("taken"),
                      F.least(copies, F.lit(max_uses).cast("long")).alias("copies"),
                      *[F.col(f"_carry_{c}").alias(f"carried_{c}") for c in carry])


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def repeat_documents(docs: DataFrame, size: Column, sources: Column, seed: str = "mix") -> DataFrame:
    """The rows of ``docs`` as often as the mix uses them, with the columns of ``docs``."""
    names = docs.columns
    out = mix(docs, size, sources, seed, carry=tuple(names))
    used = out.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return used.select(*[F.col(f"carried_{c}").alias(c) for c in names])
