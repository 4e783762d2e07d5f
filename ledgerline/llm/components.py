"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import drop, spill


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node points at one root at most and no root points anywhere: the contraction's fixed point."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("b").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("root")))
    ends = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("root").alias("root"))
    return ends.where("out + root > 1").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of ``links(a, b)``; component is its smallest id.

    Large-star then small-star until the edges are stars: O(log^2 n) rounds.
    A hub only ever contributes its minimum, found with map-side combining,
    and the joins back are plain equi-joins that AQE can split.
    Each round is a table in the shared folder.  Null ids and self-links are
    ignored; no links give no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = spill(edges.where(F.col("a") > F.col("b")).distinct(), "links")
    while not _is_stars(edges):
        # large star: every larger neighbour of u moves to the least node around u
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = spill(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star")
        large = (both.where(F.col("b") > F.col("a")).join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = spill(large, "large")
        drop(least)
        # small star: the smaller neighbours of u, and u itself, move to the least of them
        least = spill(large.groupBy("a").agg(F.min("b").alias("m")), "star")
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b")))
                 .where(F.col("a") > F.col("b")).distinct())
        small = spill(small, "links")
        drop(edges, least, large)
        edges = small
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
