"""Connected components of a table of links, by alternating large-star and small-star steps.

Both steps only group and join, hubs are pre-aggregated, and each step's links are written to
the shared folder, so neither a hub nor a component is ever held by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.scratch import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("child", "parent").union(links.select(F.col("parent"), F.col("child")))
    both = both.toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = both.where("v > u").join(least, "u")
    return joined.select(F.col("v").alias("child"), F.col("m").alias("parent")).where("child != parent").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("child").agg(F.min("parent").alias("m"))
    joined = links.join(least, "child")
    out = joined.select(F.explode(F.array("child", "parent")).alias("child"), F.col("m").alias("parent"))
    return out.where("child != parent").distinct()


def _is_forest_of_stars(links: DataFrame) -> bool:
    """Every child has one parent, and no parent is a child: nothing would change any more."""
    ends = links.select(F.explode(F.array(F.struct(F.col("child").alias("v"), F.lit(1).alias("c")), F.struct(F.col("parent").alias("v"), F.lit(0).alias("c")))).alias("x"))
    ends = ends.groupBy("x.v").agg(F.sum("x.c").alias("as_child"), F.min("x.c").alias("least"))
    return ends.where("as_child > 1 OR (as_child = 1 AND least = 0)").isEmpty()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``links`` (child, parent: longs, child > parent) -> (child, parent): each vertex but the
    smallest of its component, with that smallest vertex. No links give no rows."""
    while True:
        links = scratch.written(_small_star(_large_star(links)), "stars")
        if _is_forest_of_stars(links):
            return links
