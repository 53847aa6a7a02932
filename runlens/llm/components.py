"""Connected components of a graph given as links between numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that `links` (a long, b long) names; root is its smallest node.

    Large-star and small-star steps in turn (Kiveris et al., 2014): each node's
    neighbours move to the smallest one. Every step is an aggregate and a join on
    tables in the shared folder, so no node's links meet in one task and a join side
    with a hot node can be split at run time. Links of a node with itself and repeated
    links do no harm; no links give no rows.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(links.distinct(), "links", narrow=True)
    while True:
        # Large star: neighbours above a node go to the smallest around it.
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        least = stored(least, "least", narrow=True)
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = stored(moved, "large-star", narrow=True)
        # Small star: neighbours below a node, and the node, go to the smallest of them.
        least = stored(links.groupBy("a").agg(F.min("b").alias("m")), "least", narrow=True)
        moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        kept = least.select("a", F.col("m").alias("b"))
        links = stored(moved.union(kept).where("a <> b").distinct(), "small-star", narrow=True)
        # Done when every node has one link down at most, and none goes to a node that has one.
        ends = links.select("a", F.lit(1).alias("down"), F.lit(0).alias("up")).union(
            links.select("b", F.lit(0), F.lit(1))
        )
        seen = ends.groupBy("a").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
        if seen.where("down > 1 or down = 1 and up = 1").isEmpty():
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
