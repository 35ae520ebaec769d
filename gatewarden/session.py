"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Event times carry no zone; pinning UTC keeps every cast an identity.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: joins turn into broadcasts only when the measured
    # size allows it, and oversized shuffle partitions of a join are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# What streams with state of their own need besides (``streaming/rolling.py``).
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "gatewarden", **overrides: str) -> SparkSession:
    """Session with the settings above; master and sizing come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
