"""Connected components of a link table by alternating star steps, in DataFrame operations.

Each step replaces the neighbours of a node by links to its smallest neighbour, so a hub's
links are joined and aggregated, never gathered.  The steps end when every node is linked
to its component's smallest node only; their number grows with the logarithm of the
longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm._blocks import drop, merged, store


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``links`` (a, b), comparable node ids, to (node, label): label is the smallest node reachable.

    Nodes without a link to another node are not returned.
    """
    keep = lambda df, name: store(spark, df, name, free=False)
    edges = keep(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "links")
    while not _stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.filter("b > a").join(merged(low), "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # every node keeps a link to its smallest neighbour
        large = large.union(low.filter("m < a").select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        large = keep(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(merged(least), "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b")))
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
        small = keep(small, "small-star")
        drop(spark, edges), drop(spark, large)
        edges = small
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one link down or is linked to from above, never both: finished."""
    roles = (edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
             .union(edges.select("b", F.lit(0), F.lit(1))))
    return (roles.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
            .filter("down > 1 or (down = 1 and up = 1)").isEmpty())
