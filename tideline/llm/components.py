"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of longs -> ``node, component`` (smallest node reachable), for nodes that have an edge.

    Loops and null ends count as no edge. Every round is written to the shared folder, so a lost executor costs a
    round at most; the number of rounds grows with the logarithm of the longest path. No node's neighbours are ever
    gathered: minima are aggregates, and links move by joins that Spark splits where a node is hot.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        seen = state
        now = written(_small_star(_large_star(now)), "stars")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
