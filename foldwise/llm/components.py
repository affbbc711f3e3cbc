"""Connected components of an edge table, by alternating star steps.

Every step is a grouped aggregation on the vertex, no neighbour list is ever
gathered, so a vertex with any number of neighbours is only a larger count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                          F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the smallest vertex around u."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every vertex of ``edges`` (a, b): root is the smallest
    vertex of its component.  A round ends with a stored table; the driver sees
    two numbers per round.  Self-loops are ignored."""
    now = materialize(edges.select("a", "b").where("a <> b").distinct())
    mark = None
    for _ in range(max_rounds):
        now = materialize(_small_star(_large_star(now)))
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = state
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
