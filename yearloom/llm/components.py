"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import checkpoint


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of edges(a, b) but those that are the least of theirs; label is the least reachable.

    The rounds end: each lets a node point at a lesser one or changes nothing, and their number grows with the square of
    the logarithm of the nodes.
    Only edges move, in joins and partial minima; each round's edges are checkpointed.  A node of many edges spreads as a
    skewed join does.
    """
    edges = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = checkpoint(small.where("a <> b").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        seen = state
