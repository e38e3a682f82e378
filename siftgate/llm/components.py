"""Connected components of an edge table, without gathering a node's edges or any component in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siftgate.sources.storage import materialise


def stars(edges: DataFrame) -> DataFrame:
    """(node, root): for every node with an edge to another, the least node of its component.

    Alternates hanging larger and smaller neighbours on the least neighbour until every edge leads to a root; the
    number of rounds grows with the logarithm of the diameter. Each round is written to the shared folder. Minima are
    partial sums, and a node with very many edges meets them in an equality join that AQE splits.
    """
    now = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(
            down.select(F.col("m").alias("a"), "b")).filter("a <> b").distinct()
        now = materialise(small)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = state
