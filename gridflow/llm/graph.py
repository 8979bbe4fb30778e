"""Connected components of a link table by alternating large and small stars.

Every step is a grouped minimum (pre-aggregated before the shuffle) joined back on the node, so
a node with a third of all links is a skewed join that adaptive execution splits, never a
collected group. Each round is checkpointed to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow.llm.common import compact, cut, partitions_for


def _towards_min(rows: DataFrame) -> DataFrame:
    """rows (x, y): adds m, the least of x and its y's."""
    least = rows.groupBy("x").agg(F.min("y").alias("m")).select(
        F.col("x").alias("x2"), F.least("x", "m").alias("m"))
    return rows.join(least, F.col("x") == F.col("x2")).select("x", "y", "m")


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, component): the least node reachable, for every linked node.

    Direction, order, repeats and self links do not matter; rows with a null end are no links.
    """
    e, n = compact(links.where("a <> b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct())
    parts, seen = partitions_for(n), None  # the links only get fewer
    while n:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        # a union has the partitions of both sides; few rows go back to few, where one needs no shuffle
        both = e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y"))).coalesce(parts)
        large = _towards_min(both).where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        star = _towards_min(large)
        e = cut(star.select("x", F.col("m").alias("y"))
                .unionByName(star.where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y")))
                .coalesce(parts).distinct()).coalesce(parts)
    return e.select(F.col("x").alias("node"), F.col("y").alias("component")).unionByName(
        e.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct())
