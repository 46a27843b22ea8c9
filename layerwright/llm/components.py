"""Connected components by alternating stars, on edges that never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright import session


def components(edges: DataFrame) -> DataFrame:
    """`node` and `component` (its smallest reachable node) for every node of `edges` (columns a and b, both long).

    Each round hangs all neighbours of a node on the smallest one, first the larger neighbours, then the smaller ones; the
    number of rounds grows with the logarithm of the number of nodes. A node's minimum is made by a partial aggregate, so
    a node with very many neighbours does not meet them in one task.
    """
    links = session.staged(edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = tuple(links.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
        if state == before or not state[0]:
            return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = state
        both = links.union(links.select("b", "a")).toDF("u", "v")
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = session.staged(large, "large-star")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            lowest.select("a", F.col("m").alias("b")))
        links = session.staged(small.filter(F.col("a") != F.col("b")).distinct(), "links")
