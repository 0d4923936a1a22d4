"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _least(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours v."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _stars(edges: DataFrame) -> bool:
    """Whether no id leads to two others, or is led to and leads on itself; then each leads to its component's smallest."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where(F.col("out") + F.col("into") > 1).where("out > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in links(a, b): the smallest id that it can reach.

    Each round relinks every id to the smallest it knows, until all links lead
    to their component's smallest id. Neighbours are only ever reduced to their
    minimum, so a component of any size, or an id with any number of links, is
    spread over tasks. Joins are merged, so that rounds leave no broadcasts with the driver.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # cut in the middle too, as the driver makes a plan anew after each of its shuffles
        large = cut(both.join(_least(both).hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        small = large.join(_least(large).hint("merge"), "u")
        edges = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(small.select("u", F.col("m").alias("v"))).distinct())
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
