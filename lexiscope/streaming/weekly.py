"""The weekly window as a stream: an extension, as the batch form is what papers need."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weekly_counts(events: DataFrame, ts: str = "ts", key: str = "language", late: str = "2 days") -> DataFrame:
    """(week_start, key, count) of Monday weeks, each once its watermark has passed."""
    week = F.window(F.col(ts).cast("timestamp"), "7 days", "7 days", "4 days").alias("w")  # the epoch was a Thursday
    counted = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(week, key).agg(F.count("*").alias("count"))
    return counted.select(F.col("w.start").cast("date").alias("week_start"), key, "count")
