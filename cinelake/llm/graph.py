"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import written


def _least(pairs: DataFrame) -> DataFrame:
    """Smallest neighbour of each node, the node itself included."""
    return pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; root is the smallest
    node reachable. Each round ties every node to its smallest neighbour
    (large star: larger neighbours of every node; small star: the smaller ones)
    and is written to the shared folder; the number of rounds grows with the
    logarithm of the longest chain. Nodes without a link are not listed."""
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct(), "component-links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: (v, smallest neighbour of u) for each neighbour v > u
        large = (both.where("b > a").join(_least(both), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = written(large, "component-large")
        # small star: the smaller neighbours of u and u itself to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        edges = written(small, "component-small")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state
