"""Connected components by alternating large and small stars, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a``, ``b`` long) but the roots; the root is the smallest node.

    Edges may come repeated, in either direction, or from a node to itself; null ends are left out. Each round is written
    to the shared folder. Nothing but two counts comes to the driver. Rounds grow with the logarithm of the nodes.
    """
    ends = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    stars = stored(ends.distinct(), "stars")
    while not _finished(stars):
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = stored(moved.union(least).distinct(), "stars")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _finished(stars: DataFrame) -> bool:
    """Whether every node points to one root, and no root points on."""
    ends = stars.select("u", F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        stars.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("u").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.where("out > 1 OR out = 1 AND into = 1").isEmpty()
