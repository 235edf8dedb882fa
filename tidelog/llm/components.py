"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.sources.scratch import materialise

def components(edges: DataFrame) -> DataFrame:
    """(a, b) longs, one row per link in either direction -> (node, component), component the smallest node reachable.

    Nodes without a link to another node have no row. Each round is two joins on a node with its pre-aggregated
    minimum; a hub's rows are an ordinary skewed join, which adaptive execution splits. Nothing is collected but a
    convergence flag, and each round is written to the shared folder.
    """
    now = materialise(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges"
    )
    while not _is_star_forest(now):
        now = materialise(_small_star(_large_star(now)), "edges")
    members = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(lowest, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(lowest, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(lowest.select(F.col("m").alias("a"), "b")).distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """True if every upper end has one lower end which is itself nobody's upper end."""
    ends = edges.select(F.col("b").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("low")).unionByName(
        edges.select(F.col("a").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("low"))
    )
    seen = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("low").alias("low"))
    return seen.where("up > 1 or (up = 1 and low = 1)").isEmpty()
