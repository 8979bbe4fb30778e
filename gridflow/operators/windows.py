"""Sliding event-time windows per district."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow import config as C


def with_event_time(readings: DataFrame) -> DataFrame:
    return readings.withColumn("event_time", F.timestamp_millis(F.col("t")))


def sliding_balance(readings: DataFrame, window: str = C.WINDOW_DURATION,
                    slide: str = C.SLIDE_DURATION, watermark: str | None = None) -> DataFrame:
    """Per district and sliding window: average and total power, and the number
    of readings with a node id.

    Works on batch and streaming inputs; on a stream pass ``watermark`` so
    windows close and late rows are dropped. Each reading lands in
    window/slide windows before the partial aggregate.
    """
    r = with_event_time(readings)
    if watermark:
        r = r.withWatermark("event_time", watermark)
    g = r.groupBy(F.window("event_time", window, slide).alias("w"), "district_id").agg(
        F.sum("v100").alias("s"), F.count("v100").alias("nv"), F.count("node_id").alias("num_measurements"))
    return g.select(
        "district_id",
        F.unix_millis(F.col("w.start")).alias("window_start_ms"),
        F.unix_millis(F.col("w.end")).alias("window_end_ms"),
        (F.col("s") / (F.col("nv").cast("double") * F.lit(100.0))).alias("avg_balance_kw"),
        (F.col("s") / F.lit(100.0)).alias("total_balance_kw"),
        "num_measurements")
