"""Connected components of a distributed set of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialise


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _turn(edges: DataFrame, towards_smaller: bool) -> DataFrame:
    """Hang each node's neighbours on the smallest of them and itself.

    ``edges`` hold (a, b) with a > b.  The large turn moves the larger neighbours of a node,
    the small turn the smaller ones and the node.  The smallest neighbour is an aggregate that
    combines before the shuffle, and meets the links in a join that splits a hot node.
    """
    around = edges if towards_smaller else _both(edges)
    least = around.groupBy("a").agg(F.min("b").alias("least")).withColumn(
        "least", F.least("a", "least"))
    joined = around.join(least, "a")
    if towards_smaller:
        moved = joined.where(F.col("b") != F.col("least")).select(
            F.col("b").alias("a"), F.col("least").alias("b"))
        return moved.union(least.select("a", F.col("least").alias("b"))).distinct()
    return joined.where(F.col("b") > F.col("a")).select(
        F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node with a link.

    Alternates the two turns until nothing changes; every round is written to the shared
    scratch folder, so no lineage grows and a lost executor costs one round at most.
    """
    def stamp(edges: DataFrame) -> tuple:
        mixed: Column = F.xxhash64("a", "b")
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(mixed, 20)),
                               F.bit_xor(mixed)).first())

    edges = materialise(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"),
                                                 F.least(a, b).alias("b")).distinct(), "links")
    seen = stamp(edges)
    while True:
        edges = materialise(_turn(_turn(edges, False), True), "links")
        now = stamp(edges)
        if now == seen:
            # Stars: every node hangs on its root.
            roots = edges.select(F.col("b").alias("node")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                roots.select("node", F.col("node").alias("root")))
        seen = now
