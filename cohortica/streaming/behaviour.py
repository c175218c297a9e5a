"""Behaviour features of respondents from an event stream, in event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def behaviour_windows(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """window, user_id, n_events, n_types, total_value; batch or stream. On a stream, state is dropped once the watermark passes a window."""
    # watermarks take timestamps with a zone only
    marked = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events
    distinct = F.approx_count_distinct("event_type") if events.isStreaming else F.countDistinct("event_type")
    return marked.groupBy(F.window("ts", width), "user_id").agg(F.count("*").alias("n_events"), distinct.alias("n_types"), F.sum("value").alias("total_value"))
