"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortkit.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a BIGINT, b BIGINT); root is the smallest node.

    Each round links every node to the smallest neighbour (large star, then small star)
    and is written to the shared folder, so neither the lineage nor the driver grows; the
    rounds grow with the logarithm of the longest chain. A node with very many neighbours
    is merged by partial minima and split by adaptive joins.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct())
        seen = state
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        edges = materialize(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(lowest.select("a", "m")).where("a <> b").distinct()
        )
