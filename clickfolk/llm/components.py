"""Connected components of links between integer nodes, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfolk.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the least node near them: larger ones (large star) or smaller ones (small star)."""
    if large:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = sides.join(least, "a")
    if large:
        out = hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the least node of its component.

    Each round is written to the shared folder; a hub's links are spread by the skew-aware join, its least
    neighbour is found by partial aggregation. Rounds grow with the logarithm of a component's size.
    """
    edges = materialise(edges.where("a != b").select("a", "b").distinct(), "links")
    seen = None
    while True:
        edges = materialise(_star(_star(edges, True), False), "stars")
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
