"""Connected components of a link table, by alternating large-star and small-star
steps: labels never leave the executors, and a hub with millions of links is
reduced by partial aggregation before each shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(edges: DataFrame, *, large: bool) -> DataFrame:
    """Links ``u > v``: hang each node's neighbours on the smallest one."""
    spark = edges.sparkSession
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    out = joined.where("v > u") if large else joined
    out = out.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return written(out.where("u != v").distinct(), spark, "star")


def _settled(edges: DataFrame) -> bool:
    """Every node hangs on one other node that itself hangs on none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return sums.where("up > 1 or up = 1 and down > 0").isEmpty()


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a, b``);
    the component is its smallest node. Ends when all trees are stars."""
    spark = links.sparkSession
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, spark, "links")
    while not _settled(edges):
        edges = _star(_star(edges, large=True), large=False)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
