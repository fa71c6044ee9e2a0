"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultweave.llm.common import saved_alone as saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link larger neighbours of a vertex to its least neighbour (itself included).
    Small star: the same for the smaller neighbours and the vertex itself."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = near.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        out = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter("u != v")


def _settled(edges: DataFrame) -> bool:
    """Whether distinct edges from larger to smaller ids are stars already: no vertex has two smaller neighbours,
    or a smaller and a larger one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    per = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return per.filter("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` pairs of long ids to ``(node, component)``, the least id that a node reaches;
    only nodes that have an edge. Each step is written to the checkpoint folder; the steps end when every
    component is one star. A star with any number of leaves is summed before it is shuffled, and joins on
    its centre can be split."""
    edges = saved(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    while not _settled(edges):
        edges = saved(_star(_star(edges, True), False).distinct(), "cc")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
