"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import land


def components(links: DataFrame, land=land) -> DataFrame:
    """(node, root) for every node of a table (a, b): root is the least node of its component.

    Each round lets every node hand its larger neighbours, then its smaller
    ones, to its least neighbour; the table stays as large as the links and is
    landed per round.  Rounds grow with the logarithm of the longest chain; links that are stars already need none.
    """
    e = land(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .filter(F.col("u") != F.col("v")).distinct(), "links")
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.filter(F.col("v") > F.col("u")).join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = land(large, "large-star")  # a row for each of e; repeated ones go with the small stars
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        j = large.join(m, "u")
        small = (j.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(m.select("u", F.col("m").alias("v"))).distinct())
        e = land(small, "small-star")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _stars(e: DataFrame) -> bool:
    """Whether every u has one v, which is no u itself (of different pairs u > v)."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter(
        F.col("up") + F.col("down") > 1).isEmpty()
