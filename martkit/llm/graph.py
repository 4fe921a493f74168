"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them. ``edges`` has a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    joined = edges.join(least, "a")
    return (joined.select("a", F.col("low").alias("b"))
            .union(joined.filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))).distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) with the smallest node it reaches.

    Neighbour minima are combined before the shuffle and rows of a hub are only
    joined, never gathered. Each round is checkpointed in the shared folder; the
    rounds end when a round changes no edge, so every node hangs on its minimum.
    """
    edges = cut(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct())
    state = _state(edges)
    while state[0]:
        edges = cut(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == state:
            break
        state = now
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(edges.select("b", "b")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"),
                           F.sum(F.xxhash64("a", "b") % 1_000_003)).first())
