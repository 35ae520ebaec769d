"""Profiles of external addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.members import with_group_counts
from gatewarden.functions.severity import actor_severity
from gatewarden.functions.shared import computed_once
from gatewarden.operators import FLOOR
from gatewarden.operators.accounts import activity_cells
from gatewarden.sources.warehouse import Warehouse


def _profile(cells: DataFrame) -> DataFrame:
    return cells.groupBy("source_ip").agg(
        F.sum("events").alias("total_attempts"),
        F.sum("failures").alias("failed_attempts"),
        F.sum("successes").alias("successful_logins"),
        F.countDistinct("user_id").alias("unique_users_targeted"),
        F.countDistinct("host_id").alias("unique_hosts_targeted"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )


def _cells_with_hosts(wh: Warehouse, since: str | None, how: str) -> DataFrame:
    hosts = wh.hosts.select(F.col("host_id").alias("dest_host_id"), "host_id")
    return (
        activity_cells(wh.events_since(since).filter("is_external"))
        .join(wh.users.select("user_id"), "user_id")
        .join(hosts, "dest_host_id", how)
    )


def external_ip_summary(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """Per external address: outcomes, distinct users and hosts, first and last seen."""
    return _profile(_cells_with_hosts(wh, since, "left")).orderBy(
        F.desc("successful_logins"), F.desc("total_attempts"), "source_ip"
    )


def external_ip_summary_known_hosts(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """The same over events with a known host, busiest first."""
    return _profile(_cells_with_hosts(wh, since, "inner")).orderBy(
        F.desc("total_attempts"), "source_ip"
    )


def _user_cells(wh: Warehouse, since: str | None) -> DataFrame:
    """External events collapsed to (address, user), with the user's name."""
    return (
        wh.events_since(since)
        .filter("is_external")
        .groupBy("source_ip", "user_id")
        .agg(
            F.count("*").alias("events"),
            F.count_if("success").alias("successes"),
            F.count_if(~F.col("success")).alias("failures"),
            F.min("event_timestamp").alias("first_seen"),
            F.max("event_timestamp").alias("last_seen"),
        )
        .join(wh.users.select("user_id", "username"), "user_id")
    )


def external_threats(wh: Warehouse, min_attempts: int = 1, since: str | None = None) -> DataFrame:
    """External addresses with ``min_attempts`` events or more; hosts are not joined."""
    return (
        _user_cells(wh, since)
        .groupBy("source_ip")
        .agg(
            F.sum("events").alias("total_attempts"),
            F.sum("failures").alias("failed_attempts"),
            F.sum("successes").alias("successful_logins"),
            F.count("*").alias("unique_users_targeted"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
        )
        .filter(F.col("total_attempts") >= min_attempts)
        .orderBy(F.desc("successful_logins"), F.desc("total_attempts"), "source_ip")
    )


def threat_actors(wh: Warehouse, since: str | None = FLOOR, **join_limits) -> DataFrame:
    """External addresses with a severity, one row per account of each."""
    return rate_actors(computed_once(_user_cells(wh, since)), **join_limits)


def rate_actors(cells: DataFrame, **join_limits) -> DataFrame:
    """Severity-rated actors from stored (address, user) cells with usernames.

    → ip_address, total_attempts, successful, failed, users_targeted, username,
    severity; the counts repeat on every account's row.
    """
    groups = computed_once(
        cells.groupBy("source_ip").agg(
            F.sum("events").alias("total_attempts"),
            F.sum("successes").alias("successful"),
            F.sum("failures").alias("failed"),
            F.count("*").alias("users_targeted"),
        )
    )
    severity = actor_severity(F.col("successful"), F.col("failed"), F.col("users_targeted"))
    return (
        with_group_counts(
            cells.select("source_ip", "username"), groups, ["source_ip"], "users_targeted",
            "username", **join_limits,
        )
        .select(
            F.col("source_ip").alias("ip_address"), "total_attempts", "successful", "failed",
            "users_targeted", "username", severity.alias("severity"),
        )
        .orderBy(F.desc("successful"), F.desc("total_attempts"), "ip_address", "username")
    )
