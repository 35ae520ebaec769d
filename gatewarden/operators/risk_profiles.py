"""Ratings and comparisons of accounts and addresses.

The catalogue describes these rules next to its queries without giving SQL;
thresholds are the ones it names.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewarden.functions.addresses import PRIVATE_NETWORKS, external_flag
from gatewarden.functions.rolling import distinct_trailing, second_cells, trailing
from gatewarden.functions.severity import threat_level
from gatewarden.functions.shared import computed_once
from gatewarden.operators import FLOOR
from gatewarden.operators.accounts import account_activity, activity_cells
from gatewarden.operators.brute_force import failed_pairs
from gatewarden.operators.external import external_ip_summary
from gatewarden.operators.temporal import IT_DEPARTMENTS
from gatewarden.operators.assets import HIGH_VALUE
from gatewarden.sources.warehouse import Warehouse

# Flags of an account in order of urgency, with their level.
ANOMALY_LEVELS = {
    "under_attack": "CRITICAL",
    "many_addresses": "CRITICAL",
    "wide_access": "CRITICAL",
    "privileged_failures": "MODERATE",
    "single_use": "MODERATE",
    "busy_day": "MODERATE",
    "predictable": "INFORMATIONAL",
}

# Shifts of the day and the hours they start.
DAY_SHIFT, EVENING_SHIFT, NIGHT_SHIFT = "DAY_SHIFT", "EVENING_SHIFT", "NIGHT_SHIFT"


def spray_outcomes(wh: Warehouse, threshold: int = 5, since: str | None = FLOOR) -> DataFrame:
    """Spraying addresses that also logged in, at any time → source_ip, users_targeted,
    successful_logins, users_reached. ``sequences.spray_entries`` asks for the order."""
    pairs = wh.events_since(since).groupBy("source_ip", "user_id").agg(
        F.count_if(~F.col("success")).alias("failures"),
        F.count_if("success").alias("successes"),
    )
    return (
        pairs.groupBy("source_ip")
        .agg(
            F.count_if(F.col("failures") > 0).alias("users_targeted"),
            F.sum("successes").alias("successful_logins"),
            F.count_if(F.col("successes") > 0).alias("users_reached"),
        )
        .filter((F.col("users_targeted") >= threshold) & (F.col("successful_logins") > 0))
        .orderBy(F.desc("successful_logins"), "source_ip")
    )


def critical_asset_outcomes(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """High-value hosts where an attacked (user, address) also got in, at any time.

    → hostname, asset_criticality, username, source_ip, failed_attempts,
    successful_logins.
    """
    cells = (
        wh.events_since(since)
        .filter(F.col("dest_host_id").isNotNull())
        .groupBy("dest_host_id", "user_id", "source_ip")
        .agg(
            F.count_if(~F.col("success")).alias("failed_attempts"),
            F.count_if("success").alias("successful_logins"),
        )
        .filter((F.col("failed_attempts") > 0) & (F.col("successful_logins") > 0))
    )
    hosts = wh.hosts.filter(F.col("asset_criticality").isin(*HIGH_VALUE)).select(
        F.col("host_id").alias("dest_host_id"), "hostname", "asset_criticality"
    )
    return (
        cells.join(hosts, "dest_host_id")
        .join(wh.users.select("user_id", "username"), "user_id")
        .select(
            "hostname", "asset_criticality", "username", "source_ip", "failed_attempts",
            "successful_logins",
        )
        .orderBy(
            "asset_criticality", F.desc("failed_attempts"), "hostname", "username", "source_ip"
        )
    )


def external_threat_levels(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """The external summary with a threat_level."""
    level = threat_level(
        F.col("total_attempts"), F.col("failed_attempts"), F.col("successful_logins"),
        F.col("unique_users_targeted"), F.col("first_seen"), F.col("last_seen"),
    )
    return external_ip_summary(wh, since).withColumn("threat_level", level)


def external_ip_summary_private_ranges(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """The external summary with every private network counted as internal."""
    flag = external_flag(F.col("source_ip"), F.col("source_ip_num"), PRIVATE_NETWORKS)
    return external_ip_summary(wh.with_events(wh.events.withColumn("is_external", flag)), since)


def external_daily_activity(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """→ source_ip, date, total_attempts, failed_attempts, successful_logins."""
    return (
        wh.events_since(since)
        .filter("is_external")
        .groupBy("source_ip", F.to_date("event_timestamp").alias("date"))
        .agg(
            F.count("*").alias("total_attempts"),
            F.count_if(~F.col("success")).alias("failed_attempts"),
            F.count_if("success").alias("successful_logins"),
        )
        .orderBy("date", F.desc("total_attempts"), "source_ip")
    )


def account_anomalies(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """Accounts with at least one flag → username, level, flags (joined, most urgent first)."""
    # one pass for both peaks: addresses in any trailing hour, and events per day
    cells = computed_once(
        second_cells(wh.events_since(since), "user_id", "source_ip", seen=F.count("*"))
    )
    addresses = (
        distinct_trailing(cells, ["user_id"], "source_ip", 3600, "addresses")
        .groupBy("user_id").agg(F.max("addresses").alias("addresses_in_an_hour"))
    )
    days = (
        cells.groupBy("user_id", F.floor(F.col("second") / 86400).alias("day"))
        .agg(F.sum("seen").alias("seen"))
        .groupBy("user_id").agg(F.max("seen").alias("busiest_day"))
    )
    peaks = (
        addresses.join(days, "user_id")
        .join(wh.users.select("user_id", "username"), "user_id")
        .drop("user_id")
    )
    profile = account_activity(wh, since).join(peaks, "username")
    failed, total = F.col("failed_logins"), F.col("total_events")
    ips, hosts = F.col("unique_source_ips"), F.col("unique_hosts_accessed")
    outside_it = F.coalesce(~F.col("department").isin(*IT_DEPARTMENTS), F.lit(True))
    rules = {
        "under_attack": (failed > F.col("successful_logins")) & (failed >= 5),
        "many_addresses": F.col("addresses_in_an_hour") >= 5,
        "wide_access": (hosts > 10) & outside_it,
        "privileged_failures": F.col("is_privileged") & (failed >= 3),
        "single_use": total == 1,
        "busy_day": F.col("busiest_day") > 100,
        "predictable": (ips == 1) & (hosts == 1),
    }
    flags = F.array_compact(F.array(*[F.when(rule, name) for name, rule in rules.items()]))
    levels = F.create_map(*[F.lit(x) for pair in ANOMALY_LEVELS.items() for x in pair])
    return (
        profile.withColumn("found", flags)
        .filter(F.size("found") > 0)
        .select(
            "username",
            levels[F.col("found")[0]].alias("level"),
            F.array_join("found", ", ").alias("flags"),
        )
        .orderBy("username")
    )


def activity_spikes(wh: Warehouse, factor: float = 2.0, days: int = 30,
                    since: str | None = FLOOR) -> DataFrame:
    """Days on which a user exceeded ``factor`` times the mean of the active days before.

    → username, date, events, peak_hour_events (the most in an hour that ends
    that day), baseline. One row per user and day enters the window, so its
    partitions are bounded by the days kept.
    """
    cells = second_cells(wh.events_since(since), "user_id", seen=F.count("*"))
    daily = (
        trailing(cells, ["user_id"], 3600, "seen", "in_an_hour")
        .groupBy("user_id", F.floor(F.col("second") / 86400).cast("int").alias("day_no"))
        .agg(F.sum("seen").alias("events"), F.max("in_an_hour").alias("peak_hour_events"))
        .withColumn("date", F.date_from_unix_date("day_no"))
    )
    before = Window.partitionBy("user_id").orderBy("day_no").rangeBetween(-days, -1)
    return (
        daily.withColumns(
            {"sum_before": F.sum("events").over(before), "days_before": F.count("*").over(before)}
        )
        .filter(F.col("events") * F.col("days_before") > F.col("sum_before") * factor)
        .join(wh.users.select("user_id", "username"), "user_id")
        .select(
            "username", "date", "events", "peak_hour_events",
            (F.col("sum_before") / F.col("days_before")).alias("baseline"),
        )
        .orderBy(F.desc("events"), "username", "date")
    )


def peer_comparison(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """Hosts reached per account next to the mean of its department.

    → username, department, unique_hosts_accessed, department_mean.
    """
    activity = account_activity(wh, since).select(
        "username", "department", "unique_hosts_accessed"
    )
    means = activity.groupBy("department").agg(
        F.sum("unique_hosts_accessed").alias("hosts"), F.count("*").alias("accounts")
    )
    return (
        activity.alias("own").join(
            means.withColumnRenamed("department", "peers"),
            F.col("own.department").eqNullSafe(F.col("peers")),  # no department is one too
        )
        .select(
            "username", "own.department", "unique_hosts_accessed",
            (F.col("hosts") / F.col("accounts")).alias("department_mean"),
        )
        .orderBy(F.desc("unique_hosts_accessed"), "username")
    )


def dormant_accounts(wh: Warehouse, as_of: str, days: int = 90) -> DataFrame:
    """Accounts without an event in the last ``days`` → username, department,
    is_privileged, last_activity (NULL: never used)."""
    start = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    last = wh.events.groupBy("user_id").agg(F.max("event_timestamp").alias("last_activity"))
    return (
        wh.users.join(last, "user_id", "left")
        .filter(F.col("last_activity").isNull() | (F.col("last_activity") <= start))
        .select("username", "department", "is_privileged", "last_activity")
        .orderBy(F.asc_nulls_first("last_activity"), "username")
    )


def shift_activity(wh: Warehouse, holidays: tuple[date, ...] = (),
                   since: str | None = FLOOR) -> DataFrame:
    """→ shift, is_holiday, event_count, failed_attempts."""
    hour, day = F.hour("event_timestamp"), F.to_date("event_timestamp")
    shift = (
        F.when(hour.between(6, 13), DAY_SHIFT).when(hour.between(14, 21), EVENING_SHIFT)
        .otherwise(NIGHT_SHIFT)
    )
    is_holiday = day.isin(*[F.lit(d) for d in holidays]) if holidays else F.lit(False)
    return (
        wh.events_since(since)
        .groupBy(shift.alias("shift"), is_holiday.alias("is_holiday"))
        .agg(
            F.count("*").alias("event_count"),
            F.count_if(~F.col("success")).alias("failed_attempts"),
        )
        .orderBy("shift", "is_holiday")
    )


def week_over_week(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """Failures per day next to the same weekday a week before.

    → date, failed_attempts, week_before, change (NULL without that day).
    """
    daily = (
        wh.events_since(since)
        .filter(~F.col("success"))
        .groupBy(F.to_date("event_timestamp").alias("date"))
        .agg(F.count("*").alias("failed_attempts"))
    )
    earlier = daily.select(
        F.date_add("date", 7).alias("date"), F.col("failed_attempts").alias("week_before")
    )
    return (
        daily.join(earlier, "date", "left")
        .withColumn("change", F.col("failed_attempts") - F.col("week_before"))
        .orderBy("date")
    )


def quarterly_trend(wh: Warehouse, since: str | None = None) -> DataFrame:
    """→ year, quarter, event_count, failed_attempts."""
    return (
        wh.events_since(since)
        .groupBy(
            F.year("event_timestamp").alias("year"), F.quarter("event_timestamp").alias("quarter")
        )
        .agg(
            F.count("*").alias("event_count"),
            F.count_if(~F.col("success")).alias("failed_attempts"),
        )
        .orderBy("year", "quarter")
    )


def lateral_movement(wh: Warehouse, hosts: int = 10, levels: int = 3,
                     expected: tuple[str, ...] = IT_DEPARTMENTS,
                     since: str | None = FLOOR) -> DataFrame:
    """Accounts outside the expected departments that reached many hosts or criticalities.

    → username, department, hosts_reached, criticalities, criticality_levels.
    """
    reached = (
        activity_cells(wh.events_since(since).filter(F.col("success")))
        .groupBy("user_id", F.col("dest_host_id").alias("host_id"))
        .agg(F.sum("events").alias("events"))
        .join(wh.hosts.select("host_id", "asset_criticality"), "host_id")
        .groupBy("user_id")
        .agg(
            F.count("*").alias("hosts_reached"),
            F.array_sort(F.collect_set("asset_criticality")).alias("kinds"),  # at most four
        )
        .filter((F.col("hosts_reached") > hosts) | (F.size("kinds") >= levels))
    )
    outside = F.coalesce(~F.col("department").isin(*expected), F.lit(True))
    users = wh.users.filter(outside)
    return (
        reached.join(users, "user_id")
        .select(
            "username", "department", "hosts_reached",
            F.size("kinds").alias("criticality_levels"),
            F.array_join("kinds", ", ").alias("criticalities"),
        )
        .orderBy(F.desc("hosts_reached"), "username")
    )


def sprayed_accounts(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """Failures per (address, account), one row each: the long form of the account lists."""
    return (
        failed_pairs(wh.events_since(since))
        .join(wh.users.select("user_id", "username"), "user_id")
        .select("source_ip", "username", "failed_attempts", "first_attempt", "last_attempt")
        .orderBy("source_ip", "username")
    )
