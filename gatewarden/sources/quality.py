"""Constraint checks as jobs: keys, references, allowed values, addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.addresses import IPV6_PATTERN
from gatewarden.sources import schemas
from gatewarden.sources.warehouse import Warehouse


def constraint_violations(wh: Warehouse) -> DataFrame:
    """One row per rule → table_name, rule, violations (0 when it holds)."""
    users, hosts, events = wh.users, wh.hosts, wh.events
    criticality = F.col("asset_criticality")
    malformed = F.col("source_ip_num").isNull() & ~F.col("source_ip").rlike(IPV6_PATTERN)
    parts = [
        _duplicates(users, "dim_users", "user_id"),
        _duplicates(users, "dim_users", "username"),
        _duplicates(hosts, "dim_hosts", "host_id"),
        _duplicates(hosts, "dim_hosts", "hostname"),
        _duplicates(events, "fact_auth_events", "event_id"),
        _breaches(users, "dim_users", {
            "user_id not null": F.col("user_id").isNull(),
            "username not null": F.col("username").isNull(),
        }),
        _breaches(hosts, "dim_hosts", {
            "host_id not null": F.col("host_id").isNull(),
            "hostname not null": F.col("hostname").isNull(),
            "asset_criticality allowed": ~criticality.isin(*schemas.CRITICALITIES),
        }),
        _breaches(events, "fact_auth_events", {
            "event_id not null": F.col("event_id").isNull(),
            "user_id not null": F.col("user_id").isNull(),
            "source_ip not null": F.col("source_ip").isNull(),
            "source_ip well formed": malformed,
            "success not null": F.col("success").isNull(),
            "event_timestamp not null": F.col("event_timestamp").isNull(),
        }),
        _orphans(events, "user_id", users, "user_id"),
        _orphans(events, "dest_host_id", hosts, "host_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


def orphan_events(wh: Warehouse) -> DataFrame:
    """The events whose user or (given) host is missing from its dimension."""
    no_user = wh.events.join(wh.users.select("user_id"), "user_id", "left_anti")
    hosts = wh.hosts.select(F.col("host_id").alias("dest_host_id"))
    no_host = wh.events.filter(F.col("dest_host_id").isNotNull()).join(
        hosts, "dest_host_id", "left_anti"
    )
    return no_user.withColumn("missing", F.lit("user")).unionByName(
        no_host.withColumn("missing", F.lit("host"))
    )


def unreadable_addresses(wh: Warehouse) -> DataFrame:
    """Events whose address is neither IPv4 nor IPv6; no scope test selects them."""
    return wh.events.filter(F.col("is_external").isNull())


def calendar_coverage(wh: Warehouse) -> DataFrame:
    """→ total_events, covered_events, uncovered_events.

    Temporal jobs leave events outside the calendar out, as an inner join to
    the hour dimension would.
    """
    inside = F.count_if(wh.calendar.covers(F.col("event_timestamp")))
    total = F.count("*")
    return wh.events.agg(
        total.alias("total_events"),
        inside.alias("covered_events"),
        (total - inside).alias("uncovered_events"),
    )


def _row(table: str, rule: str, violations: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        violations.cast("bigint").alias("violations"),
    ]


def _duplicates(frame: DataFrame, table: str, key: str) -> DataFrame:
    """Rows beyond the first of each key."""
    counted = frame.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("copies"))
    extra = counted.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("extra"))
    return extra.select(*_row(table, f"{key} unique", F.col("extra")))


def _breaches(frame: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Row-level rules, all counted in one scan."""
    counts = frame.agg(
        *[F.count_if(broken).alias(f"r{i}") for i, broken in enumerate(rules.values())]
    )
    rows = [
        F.struct(*_row(table, rule, F.col(f"r{i}"))) for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _orphans(events: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """References without a target; counted per value first, so a hot value is one row."""
    used = (
        events.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("ref"))
        .agg(F.count("*").alias("uses"))
    )
    missing = used.join(dimension.select(F.col(key).alias("ref")), "ref", "left_anti")
    return missing.agg(F.coalesce(F.sum("uses"), F.lit(0)).alias("uses")).select(
        *_row("fact_auth_events", f"{column} references {key}", F.col("uses"))
    )
