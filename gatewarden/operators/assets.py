"""Failed logins against high-value hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.members import with_group_counts
from gatewarden.functions.shared import computed_once
from gatewarden.operators import FLOOR
from gatewarden.sources.warehouse import Warehouse

# The criticalities that count as high value, most urgent first.
HIGH_VALUE = ("CRITICAL", "HIGH")


def failed_against_hosts(wh: Warehouse, since: str | None, *keys: str) -> DataFrame:
    """Failures per host and the extra keys, on high-value hosts only."""
    counted = (
        wh.events_since(since)
        .filter(~F.col("success") & F.col("dest_host_id").isNotNull())
        .groupBy("dest_host_id", *keys)
        .agg(F.count("*").alias("attempts"))
    )
    return on_high_value_hosts(wh, counted)


def on_high_value_hosts(wh: Warehouse, counted: DataFrame) -> DataFrame:
    """Rows with ``dest_host_id`` joined to their host, if that is of high value."""
    hosts = wh.hosts.filter(F.col("asset_criticality").isin(*HIGH_VALUE))
    return counted.join(hosts, counted["dest_host_id"] == hosts["host_id"])


def urgency() -> F.Column:
    return F.when(F.col("asset_criticality") == "CRITICAL", 1).when(
        F.col("asset_criticality") == "HIGH", 2
    )


def critical_asset_attacks(wh: Warehouse, since: str | None = FLOOR,
                           **join_limits) -> DataFrame:
    """Per (host, user): attack_count, unique_attackers; one row per attacker_ip."""
    keys = ["host_id", "user_id"]
    cells = computed_once(
        failed_against_hosts(wh, since, "user_id", "source_ip")
        .select(*keys, "hostname", "asset_criticality", "location", "source_ip", "attempts")
        .join(wh.users.select("user_id", "username", "is_privileged"), "user_id")
        .withColumnRenamed("source_ip", "attacker_ip")
    )
    groups = computed_once(
        cells.groupBy(*keys).agg(
            F.sum("attempts").alias("attack_count"), F.count("*").alias("unique_attackers")
        )
    )
    return (
        with_group_counts(cells, groups, keys, "unique_attackers", "attacker_ip", **join_limits)
        .select(
            "hostname", "asset_criticality", "location", "username", "is_privileged",
            "attack_count", "unique_attackers", "attacker_ip",
        )
        .orderBy(urgency(), F.desc("attack_count"), "hostname", "username", "attacker_ip")
    )


def critical_asset_attacks_by_text(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """Earlier form: criticality sorts as text, descending; count is attack_attempts."""
    return (
        critical_asset_attacks(wh, since)
        .withColumnRenamed("attack_count", "attack_attempts")
        .orderBy(
            F.desc("asset_criticality"), F.desc("attack_attempts"), "hostname", "username",
            "attacker_ip",
        )
    )


def critical_asset_summary(wh: Warehouse, since: str | None = FLOOR,
                           **join_limits) -> DataFrame:
    """Per host: total_attacks, users_targeted, unique_attackers; one row per attacker_ip."""
    keys = ["hostname", "asset_criticality"]
    known = computed_once(
        failed_against_hosts(wh, since, "user_id", "source_ip")
        .select("user_id", *keys, "source_ip", "attempts")
        .join(wh.users.select("user_id"), "user_id")
    )
    groups = computed_once(
        known.groupBy(*keys).agg(
            F.sum("attempts").alias("total_attacks"),
            F.countDistinct("user_id").alias("users_targeted"),
            F.countDistinct("source_ip").alias("unique_attackers"),
        )
    )
    members = known.select(*keys, F.col("source_ip").alias("attacker_ip")).distinct()
    return (
        with_group_counts(members, groups, keys, "unique_attackers", "attacker_ip", **join_limits)
        .select(*keys, "total_attacks", "users_targeted", "unique_attackers", "attacker_ip")
        .orderBy("asset_criticality", F.desc("total_attacks"), "hostname", "attacker_ip")
    )


def critical_asset_hunt(wh: Warehouse, since: str | None = FLOOR, **join_limits) -> DataFrame:
    """Per host with location: attack_count, unique_attackers; one row per attacker_ip.

    Users are not joined.
    """
    cells = computed_once(
        failed_against_hosts(wh, since, "source_ip")
        .select("host_id", "hostname", "asset_criticality", "location", "attempts",
                F.col("source_ip").alias("attacker_ip"))
    )
    groups = computed_once(
        cells.groupBy("host_id").agg(
            F.sum("attempts").alias("attack_count"), F.count("*").alias("unique_attackers")
        )
    )
    return (
        with_group_counts(
            cells, groups, ["host_id"], "unique_attackers", "attacker_ip", **join_limits
        )
        .select("hostname", "asset_criticality", "location", "attack_count", "unique_attackers",
                "attacker_ip")
        .orderBy(F.desc("attack_count"), "hostname", "attacker_ip")
    )


def critical_assets_dashboard(wh: Warehouse, since: str | None = FLOOR,
                              cells: DataFrame | None = None) -> DataFrame:
    """Per host: attack_count, unique_attackers.

    ``cells``, if given, are the failures per (dest_host_id, source_ip), and the
    events are not read.
    """
    found = failed_against_hosts(wh, since, "source_ip") if cells is None else on_high_value_hosts(wh, cells)
    return (
        found
        .groupBy("hostname", "asset_criticality")
        .agg(
            F.sum("attempts").alias("attack_count"),
            F.count("*").alias("unique_attackers"),
        )
        .orderBy(F.desc("attack_count"), "hostname")
    )
