"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.session import stage


def _smallest(edges: DataFrame, node: str, other: str) -> DataFrame:
    """For each node its smallest neighbour; combined in the map tasks before the shuffle."""
    return edges.groupBy(F.col(node).alias("node")).agg(F.min(other).alias("low"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the smallest node around it, the node itself included."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _smallest(both, "a", "b").select("node", F.least("node", "low").alias("low"))
    larger = both.where(F.col("b") > F.col("a"))
    return (larger.join(low, larger["a"] == low["node"])
            .select(F.col("low").alias("a"), "b").where(F.col("a") < F.col("b")).distinct())


def small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is linked with the smallest of them."""
    low = _smallest(edges, "b", "a")  # a < b in every edge
    joined = edges.join(low, edges["b"] == low["node"])
    return (joined.select(F.col("low").alias("a"), F.col("a").alias("b"))
            .union(low.select(F.col("low").alias("a"), F.col("node").alias("b")))
            .where(F.col("a") < F.col("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for each node with an edge, the smallest node it is connected with.

    ``edges`` has columns a < b of a type with an order. Each round is written to the shared folder, so the plan stays
    short and a lost executor costs a re-read. Rounds end when the edges form stars, that is, when no node is both the
    larger end of an edge and the smaller end of another, or the larger end of two; the number of rounds grows with the
    logarithm of the longest path. A node with many neighbours is never gathered in one task: only minima are, and the
    joins can be split.
    """
    edges = stage(edges.select("a", "b").distinct(), "edges")
    while True:
        per_node = edges.groupBy(F.col("b").alias("n")).agg(F.count("*").alias("up"))
        inner = edges.select(F.col("a").alias("n")).distinct()
        unfinished = per_node.join(inner, "n", "left_semi").union(per_node.where(F.col("up") > 1))
        if unfinished.isEmpty():
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
                edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        edges = stage(small_star(large_star(edges)), "edges")
