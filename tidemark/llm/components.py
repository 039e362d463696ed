"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import settled


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each node; partial aggregation makes hubs harmless."""
    return edges.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("least"))


def _star(edges: DataFrame, upward: bool) -> DataFrame:
    """Link the neighbours of a node on one side of it to its smallest neighbour or itself."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if upward else edges
    joined = both.join(_least(both), F.col("a") == F.col("of")).select(
        "a", "b", F.least("a", "least").alias("m"))
    if upward:
        made = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        made = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            joined.select("a", F.col("m").alias("b")))
    return made.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of links ``a``, ``b``.

    Every step keeps at most as many edges as it was given. It ends when all edges point
    at the smallest node of their component, after a number of rounds that grows with the
    logarithm of the longest path. Each round is cut off by a checkpoint.
    """
    edges = settled(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        edges = settled(_star(_star(edges, upward=True), upward=False))
        # Finished when no node has two smaller neighbours and no smaller neighbour has one itself.
        twice = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        inner = edges.join(edges.select(F.col("a").alias("of")), F.col("b") == F.col("of"), "left_semi")
        if not twice.limit(1).count() and not inner.limit(1).count():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
