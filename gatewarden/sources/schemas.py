"""Declared schemas of the star; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

CRITICALITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
DEFAULT_EVENT_TYPE = "login"

USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("username", T.StringType(), False),
        T.StructField("department", T.StringType()),
        T.StructField("is_privileged", T.BooleanType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

HOSTS = T.StructType(
    [
        T.StructField("host_id", T.LongType(), False),
        T.StructField("hostname", T.StringType(), False),
        T.StructField("asset_criticality", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("user_id", T.LongType(), False),
        T.StructField("dest_host_id", T.LongType()),
        T.StructField("source_ip", T.StringType(), False),
        T.StructField("event_type", T.StringType()),
        T.StructField("success", T.BooleanType(), False),
        T.StructField("event_timestamp", T.TimestampNTZType(), False),
        T.StructField("ingested_at", T.TimestampNTZType()),
    ]
)

# Columns the stored fact table adds at load time.
STORED_EVENTS = T.StructType(
    [
        *EVENTS.fields,
        T.StructField("source_ip_num", T.LongType()),
        T.StructField("is_external", T.BooleanType()),
        T.StructField("event_date", T.DateType()),
    ]
)
