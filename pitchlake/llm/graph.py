"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import staged


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``links``: a, b (ids).  Returns node, component (the least id reachable).

    Each round points every node at the least node among its neighbours
    (first for larger neighbours, then for smaller ones), which at least
    halves the depth of the remaining trees.  A round is two aggregations with
    map-side minima and joins on the node, so a node with very many links is
    neither gathered nor windowed.  Rounds are written to the shared folder.
    """
    edges = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct(), label)
    state = None
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .unionAll(down.select("u", F.col("m").alias("v"))).distinct())
        edges = staged(small, label)
        # the edge set is final when it stops changing: then every edge is (node, root)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = tuple(now)
