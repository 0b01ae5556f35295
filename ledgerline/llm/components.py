"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import drop_written, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour v of u is linked to the least of u and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.withColumn("m", F.least("u", F.min("v").over(W.partitionBy("u"))))
    return least.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.withColumn("m", F.min("v").over(W.partitionBy("u")))
    return least.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))


def _distinct(edges: DataFrame) -> DataFrame:
    """Each edge between different nodes once, from the larger one to the smaller."""
    return edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or a smaller and a larger one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v) that is not the least of its component.

    Each step is written to the checkpoint folder; the loop ends when the edges
    are stars, whose centres are then the least of their components.
    """
    spark = edges.sparkSession
    now, path = written(_distinct(edges), "stars")
    while not _are_stars(now):
        # an edge found twice by the first star changes no minimum of the second
        new, new_path = written(_distinct(_small_star(_large_star(now).where("u != v"))), "stars")
        drop_written(spark, path)
        now, path = new, new_path
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def joined_components(known: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) as above, of the stars ``known`` with the edges ``links`` (u, v) added.

    Only components that a link touches are contracted; a node of another keeps its own.
    """
    def of(edges, c):
        named = known.select(F.col("node").alias(c), F.col("component").alias("at"))
        return edges.join(named, c, "left").withColumn(c, F.coalesce("at", c)).drop("at")

    new = connected_components(of(of(links, "u"), "v"))
    moved = new.select(F.col("node").alias("component"), F.col("component").alias("to"))
    # a component that moves was the least of its nodes, and becomes a node itself
    stars = known.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    out, _ = written(stars.union(new), "components")
    return out
