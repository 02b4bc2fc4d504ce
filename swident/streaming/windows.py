"""Event-time windows, for batch and streaming frames alike (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_counts(events: DataFrame, width: str, late: str | None = None) -> DataFrame:
    """window_start, event_type, n and total of each tumbling window."""
    e = events.withWatermark("ts", late) if late else events
    return e.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def session_counts(events: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    """user_id, session_start and n of each session that a gap ends."""
    e = events.withWatermark("ts", late) if late else events
    return e.groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("n")).select("user_id", F.col("s.start").alias("session_start"), "n")
