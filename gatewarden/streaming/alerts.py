"""Brute force and spraying over event-time windows.

Watermarks need a zoned timestamp, so the zone-free event time is cast under
the session's UTC. State is kept per window and dropped once the watermark
passes it; results are appended when a window closes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _failures(events: DataFrame, lateness: str) -> DataFrame:
    return (
        events.filter(~F.col("success"))
        .withColumn("event_time", F.col("event_timestamp").cast("timestamp"))
        .withWatermark("event_time", lateness)
    )


def _bounds(window: str) -> list:
    return [
        F.col(window)["start"].cast("timestamp_ntz").alias("window_start"),
        F.col(window)["end"].cast("timestamp_ntz").alias("window_end"),
    ]


def brute_force_alerts(events: DataFrame, period: str = "1 hour", slide: str | None = None,
                       threshold: int = 3, lateness: str = "1 hour") -> DataFrame:
    """(user, address) with ``threshold`` failures in a window.

    → window_start, window_end, user_id, source_ip, failed_attempts,
    first_attempt, last_attempt.
    """
    return (
        _failures(events, lateness)
        .groupBy(F.window("event_time", period, slide).alias("span"), "user_id", "source_ip")
        .agg(
            F.count("*").alias("failed_attempts"),
            F.min("event_timestamp").alias("first_attempt"),
            F.max("event_timestamp").alias("last_attempt"),
        )
        .filter(F.col("failed_attempts") >= threshold)
        .select(
            *_bounds("span"), "user_id", "source_ip", "failed_attempts",
            "first_attempt", "last_attempt",
        )
    )


def spraying_alerts(events: DataFrame, period: str = "1 hour", threshold: int = 5,
                    lateness: str = "1 hour") -> DataFrame:
    """Addresses failing against ``threshold`` users in a window, counted exactly.

    → window_start, window_end, source_ip, users_targeted, total_attempts. The
    first aggregation keeps one row per (window, address, user), so a hot
    address is spread over its users.
    """
    per_user = (
        _failures(events, lateness)
        .groupBy(F.window("event_time", period).alias("span"), "source_ip", "user_id")
        .agg(F.count("*").alias("attempts"))
    )
    return (
        per_user.withColumn("closing", F.window_time("span"))
        .groupBy(F.window("closing", period).alias("whole"), "source_ip")
        .agg(
            F.count("*").alias("users_targeted"),
            F.sum("attempts").alias("total_attempts"),
        )
        .filter(F.col("users_targeted") >= threshold)
        .select(*_bounds("whole"), "source_ip", "users_targeted", "total_attempts")
    )
