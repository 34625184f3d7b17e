"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component``, the smallest node reachable, for every node of ``links`` (columns ``a, b``, undirected).

    Large-star and small-star steps in turn: links of a node are moved to the smallest neighbour until each hangs on the
    smallest node of its component. Links are never copied per pair of a group, so a group of n costs n links a step. Each
    step is written to the shared folder. Links that repeat, in either direction, count once; links of a node with itself and links with a
    null end are left out; an empty table gives an empty result; other columns are ignored.
    """
    links = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b")).where("a != b").distinct()
        moved = stored(small, "links")
        # done when every node has one link and no target hangs on another node
        if moved.groupBy("a").count().where("count > 1").isEmpty() and moved.join(moved.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            rest = moved.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return rest.union(rest.select("component", "component").distinct())
        links = moved
