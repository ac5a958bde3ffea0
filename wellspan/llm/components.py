"""Connected components of an edge table, in rounds on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of the table (a, b); component is the least node reachable.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each keeps as many edges as
    there are nodes and edges at most, and neither collects a node's neighbours.  Loops and repeated
    edges are fine; an empty table gives no rows.  Rounds end when the edges are stars.
    """
    now = materialize(_oriented(edges.select("a", "b")), "edges")
    while not _are_stars(now):
        # Large star: neighbours above a node go to the least of its neighbourhood.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _oriented(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # Small star: a node and its lower neighbours go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = _oriented(small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))))
        now = materialize(small, "stars")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge down and no edge up, or none down: then its component is known."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node, without loops."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
