"""Connected components of a large graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import drop_staged
from tripweave.session import stage

EDGE = ["a", "b"]


def _least_neighbours(edges: DataFrame) -> DataFrame:
    """The smallest of every node and its neighbours, for rows (a, b) meaning that b is next to a.

    Stored, so that the join with it has a plain exchange on either side: adaptive execution can then split hubs.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("_least"))
    return stage(least.select("a", F.least("a", "_least").alias("_least")), "least-neighbours")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest one instead."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    larger = both.filter(F.col("b") > F.col("a"))
    return larger.join(_least_neighbours(both), "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    tied = down.join(_least_neighbours(down), "a").select(
        F.explode(F.array("a", "b")).alias("a"), F.col("_least").alias("b")
    )
    return tied.filter(F.col("a") != F.col("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64(*EDGE)), F.bit_xor(F.xxhash64("b", "a"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of rows (a, b) of whole numbers: the smallest node it can reach.

    Every step is one aggregation, which meets a hub as partial minima, and one join, whose hubs adaptive execution
    splits. The edges of a step are stored, so that the lineage stays short; the number of steps grows with the
    logarithm of the longest path.
    """
    now = stage(edges.filter(F.col("a") != F.col("b")).select(*EDGE).distinct(), "edges")
    before, state = None, _state(now)
    while state != before:
        last = now
        now = stage(_small_star(_large_star(last)), "edges")
        drop_staged(last)
        before, state = state, _state(now)
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
