"""District ring topology: neighbours, roles and fixed-size buckets of ranks.

Positions, previous and next members come from ``ordered_scan`` so a huge
district is split across tasks, and so do the ring ends; district sizes are
small per-district aggregates joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridflow import config as C
from gridflow.plans.ordered import ordered_scan


def ring_neighbours(values: DataFrame, **split) -> DataFrame:
    """Values of the previous and next member of each district ring, per step
    (the ring wraps around; a ring of one is its own neighbour)."""
    keys = ["district", "step"]
    s = ordered_scan(values.select(*keys, "rank", "v100"), keys, "rank", lags={"v100": "_prev"}, leads={"v100": "_next"},
                     ends={"v100": ("_first", "_last")}, **split)
    return s.select(*keys, "rank", "v100",
                    F.coalesce(F.col("_prev"), F.col("_last")).alias("prev_v100"),
                    F.coalesce(F.col("_next"), F.col("_first")).alias("next_v100"))


def rank_role(members: DataFrame, **split) -> DataFrame:
    """Role by position in the district: last = ACCUMULATOR, the first
    floor(0.6 * size) = PRODUCER, the rest CONSUMER (integer arithmetic)."""
    m = members.groupBy("district", "rank").agg(F.count(F.lit(1)).alias("_c")).drop("_c")
    s = ordered_scan(m, ["district"], "rank", position="_pos", **split)
    sizes = m.groupBy("district").agg(F.count(F.lit(1)).alias("size"))
    r = s.join(sizes, "district").withColumn("district_rank", (F.col("_pos") - 1).cast("long")).drop("_pos")
    role = (F.when(F.col("district_rank") == F.col("size") - 1, F.lit("ACCUMULATOR"))
             .when(F.col("district_rank") < F.floor(F.col("size") * C.PRODUCER_SHARE_TENTHS / 10),
                   F.lit("PRODUCER"))
             .otherwise(F.lit("CONSUMER")))
    return r.withColumn("role", role)


def district_bucket(ranks: DataFrame, nodes_per_district: int, rank_col: str = "rank") -> DataFrame:
    """Group ranks into districts of ``nodes_per_district``; flag the incomplete last one.

    Buckets are fixed-size by construction, so the per-bucket window is bounded."""
    d = F.floor(F.col(rank_col) / nodes_per_district).cast("long")
    r = ranks.select(F.col(rank_col).alias("rank")).withColumn("district", d)
    r = r.withColumn("district_rank", (F.col("rank") - F.col("district") * nodes_per_district).cast("long"))
    size = F.count(F.lit(1)).over(Window.partitionBy("district"))
    return r.withColumn("incomplete", size < nodes_per_district)
