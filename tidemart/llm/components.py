"""Connected components by alternating large and small stars, in Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import written


def _least_neighbour(sym: DataFrame) -> DataFrame:
    """Of each node ``u`` the least of itself and its neighbours ``v``."""
    least = sym.groupBy("u").agg(F.min("v").alias("m"))
    return least.select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's least neighbour."""
    sym = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = written(_least_neighbour(sym), "stars")
    larger = sym.join(least, "u").where("v > u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every smaller neighbour of a node, and the node, to the least one."""
    least = written(_least_neighbour(edges), "stars")
    smaller = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return smaller.union(own).where("u > v").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``id, root`` of every node of the edges ``u, v``; the root is the least id.

    Edges may repeat, point either way or loop; nodes with no other neighbour are
    left out. Each round is written to the shared folder; the rounds end when one
    leaves the edges as they were, which takes a logarithmic number of them.
    """
    up = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    current = written(edges.where("u != v").select(*up).distinct(), "edges")
    before = None
    while True:
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(state) == before:
            return current.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
                current.select("v", "v").distinct()
            )
        before = tuple(state)
        grown = written(_large_star(current), "edges")
        current = written(_small_star(grown), "edges")
