"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import store


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (the smallest node of its component) for every node with a link.

    Alternates large-star and small-star rounds, each a minimum per node and a
    join. Every round is stored, so a lost executor costs one round. Nodes with
    very many links are split by the planner's skew join; minima combine in the
    task before they move.
    """
    high, low = F.greatest(a, b), F.least(a, b)
    edges = store(links.select(high.alias("u"), low.alias("v")).where("u <> v").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = store(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        # done when every node has one link, to a node that has none upwards
        twice = edges.groupBy("u").count().where("count > 1").select("u")
        inner = edges.select(F.col("v").alias("u")).distinct().join(edges.select("u").distinct(), "u", "left_semi")
        if twice.unionByName(inner).isEmpty():
            break
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
