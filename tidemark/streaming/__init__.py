"""Extension: bars from a stream of events, late ones within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_bars(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """OHLC per user and day of a stream (or table) of events with ts, event_id, user_id and value."""
    order = F.struct("ts", "event_id")
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 day").alias("w"), F.col("user_id").alias("security_id"))
        .agg(F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"), F.count("*").alias("n"))
        .select("security_id", F.col("w.start").cast("date").alias("trade_date"), "open", "high", "low", "close", "n")
    )
