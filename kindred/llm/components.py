"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.session import stage


def _state(edges: DataFrame) -> tuple:
    """Count and order-free hash of the edges; equal when nothing changed."""
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every linked node; the root is the smallest node reachable.

    Each round hangs the larger neighbours of a node on its smallest neighbour, then the
    smaller ones. Every round is written to the shared folder. The smallest neighbours
    are a table of their own, so that the join can split a node with very many links.
    """
    edges = stage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(),
        "links",
    )
    before, state = None, _state(edges)
    while state != before:
        both = edges.union(edges.select("v", "u"))
        smallest = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "smallest")
        large = (
            both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # A node hung on m by way of a larger neighbour stays hung there itself.
        edges = stage(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, state = state, _state(edges)
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
