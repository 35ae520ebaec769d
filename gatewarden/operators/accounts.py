"""Account activity: the privileged audit trail and the per-user profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.severity import result_label
from gatewarden.operators import FLOOR
from gatewarden.sources.warehouse import Warehouse


def privileged_audit(wh: Warehouse, since: str | None = FLOOR, username: str | None = None,
                     keep_unknown_hosts: bool = True) -> DataFrame:
    """Every event of a privileged account, newest first."""
    users = wh.users.filter("is_privileged")
    if username is not None:
        users = users.filter(F.col("username") == username)
    hosts = wh.hosts.select(
        F.col("host_id").alias("dest_host_id"), "hostname", "asset_criticality"
    )
    return (
        wh.events_since(since)
        .join(users.select("user_id", "username", "department"), "user_id")
        .join(hosts, "dest_host_id", "left" if keep_unknown_hosts else "inner")
        .orderBy(F.desc("event_timestamp"), F.desc("event_id"))
        .select(
            "username", "department", "hostname", "asset_criticality",
            "event_type", "success", "event_timestamp", "source_ip",
        )
    )


def account_activity(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """One row per user with events: totals, distinct addresses and hosts, first and last.

    Addresses and hosts are counted as rows of two thin group-bys, so no event
    is expanded per distinct column and a hot user is spread over its values.
    """
    events = wh.events_since(since)
    totals = (
        events.groupBy("user_id", "source_ip")
        .agg(*_measures())
        .groupBy("user_id")
        .agg(
            F.sum("events").alias("total_events"),
            F.sum("successes").alias("successful_logins"),
            F.sum("failures").alias("failed_logins"),
            F.count("*").alias("unique_source_ips"),
            F.min("first_seen").alias("first_activity"),
            F.max("last_seen").alias("last_activity"),
        )
    )
    reached = (
        events.select("user_id", F.col("dest_host_id").alias("host_id"))
        .filter(F.col("host_id").isNotNull())
        .distinct()
        .join(wh.hosts.select("host_id"), "host_id")
        .groupBy("user_id")
        .agg(F.count("*").alias("known_hosts"))
    )
    return (
        totals.join(reached, "user_id", "left")
        .join(wh.users, "user_id")
        .select(
            "username", "department", "is_privileged", "total_events", "successful_logins",
            "failed_logins", "unique_source_ips",
            F.coalesce("known_hosts", F.lit(0)).alias("unique_hosts_accessed"),
            "first_activity", "last_activity",
        )
        .orderBy(F.desc("total_events"), "username")
    )


def _measures() -> list:
    return [
        F.count("*").alias("events"),
        F.count_if("success").alias("successes"),
        F.count_if(~F.col("success")).alias("failures"),
        F.min("event_timestamp").alias("first_seen"),
        F.max("event_timestamp").alias("last_seen"),
    ]


def activity_cells(events: DataFrame) -> DataFrame:
    """Events collapsed to (user, address, host).

    Distinct counts over these cells expand far fewer rows than over raw
    events, and a hot user or address is spread over its cells.
    """
    return events.groupBy("user_id", "source_ip", "dest_host_id").agg(*_measures())


def event_timeline(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """Every event in time order with its date and a result label."""
    return (
        wh.events_since(since)
        .orderBy("event_timestamp", "event_id")
        .select(
            "event_timestamp",
            F.to_date("event_timestamp").alias("date"),
            "source_ip",
            "user_id",
            "success",
            result_label(F.col("success")).alias("result"),
        )
    )
