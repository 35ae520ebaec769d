"""Star schema over the supplied trial tables (customer, supplier, nation, events)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewarden.functions.addresses import address_value
from gatewarden.functions.clock import Calendar
from gatewarden.sources.warehouse import Warehouse

EVENT_COLUMNS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)
TRIAL_CALENDAR = Calendar(date(2024, 1, 1), date(2024, 12, 31))


def trial_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.of(
        trial_users(spark, sf_dir),
        trial_hosts(spark, sf_dir),
        trial_events(spark, sf_dir),
        TRIAL_CALENDAR,
    )


def trial_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spark.read.schema(
        "c_custkey bigint, c_name string, c_mktsegment string"
    ).parquet(f"{sf_dir}/customer.parquet")
    return customers.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.when(F.col("c_custkey") % 13 != 0, F.col("c_mktsegment")).alias("department"),
        (F.col("c_custkey") % 8 == 0).alias("is_privileged"),
    )


def trial_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = spark.read.schema(
        "s_suppkey bigint, s_name string, s_nationkey int"
    ).parquet(f"{sf_dir}/supplier.parquet")
    nations = spark.read.schema("n_nationkey int, n_name string").parquet(
        f"{sf_dir}/nation.parquet"
    )
    rank = F.col("s_suppkey") % 4
    return suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey).select(
        F.col("s_suppkey").alias("host_id"),
        F.col("s_name").alias("hostname"),
        F.when(rank == 0, "CRITICAL").when(rank == 1, "HIGH").when(rank == 2, "MEDIUM")
        .otherwise("LOW").alias("asset_criticality"),
        F.col("n_name").alias("location"),
    )


def trial_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.read.schema(EVENT_COLUMNS).parquet(f"{sf_dir}/events.parquet")
    kind = F.col("kind")
    k, user = F.col("k"), F.col("user_id")
    return raw.select(
        "event_id",
        "user_id",
        F.col("event_type").alias("kind"),
        F.col("ts").alias("event_timestamp"),
        F.regexp_extract("props", r'"k": ?([0-9]+)', 1).try_cast("int").alias("k"),
    ).select(
        "event_id",
        "user_id",
        F.when(k % 11 != 0, k % 13).cast("bigint").alias("dest_host_id"),
        F.when(k < 45, F.concat_ws(".", F.lit("10"), k % 3, F.lit("0"), user % 250))
        .when(k < 53, F.concat_ws(".", F.lit("172"), k % 3 + 16, F.lit("0"), user % 250))
        .when(k < 60, F.concat_ws(".", F.lit("192.168"), k % 3, user % 250))
        .otherwise(F.concat_ws(".", F.lit("198.51"), user % 5, k))
        .alias("source_ip"),
        F.when(kind == "error", "failed_login").when(kind == "view", "logout")
        .otherwise("login").alias("event_type"),
        (kind != "error").alias("success"),
        "event_timestamp",
        # What loading would store next to the address text.
        F.when(k < 45, (k % 3) * 65536 + user % 250 + address_value("10.0.0.0"))
        .when(k < 53, (k % 3) * 65536 + user % 250 + address_value("172.16.0.0"))
        .when(k < 60, (k % 3) * 256 + user % 250 + address_value("192.168.0.0"))
        .otherwise((user % 5) * 256 + k + address_value("198.51.0.0"))
        .alias("source_ip_num"),
        (k >= 45).alias("is_external"),
    )
