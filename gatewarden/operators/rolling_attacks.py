"""Attack rules over short and rolling periods.

The catalogue describes these rules next to its queries without giving SQL;
periods and thresholds are the ones it names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.clock import epoch_second
from gatewarden.functions.rolling import (
    distinct_trailing, following, moment, second_cells, trailing,
)
from gatewarden.functions.shared import computed_once
from gatewarden.functions.skew import lookup_join
from gatewarden.operators import FLOOR
from gatewarden.operators.brute_force import brute_force
from gatewarden.sources.warehouse import Warehouse

HOUR = 3600
DAY = 86400

# Failures that raise an alert for privileged and for other users.
PRIVILEGED_FAILURES = 2
REGULAR_FAILURES = 5


def rolling_brute_force(wh: Warehouse, seconds: int = HOUR, threshold: int = 3,
                        since: str | None = FLOOR) -> DataFrame:
    """(user, address) with ``threshold`` failures inside any trailing period.

    → username, department, is_privileged, source_ip, peak_failures,
    first_alert, last_alert (whole seconds).
    """
    keys = ["user_id", "source_ip"]
    failures = wh.events_since(since).filter(~F.col("success"))
    alerts = trailing(
        second_cells(failures, *keys, failures=F.count("*")), keys, seconds,
        "failures", "recent",
    ).filter(F.col("recent") >= threshold)
    return (
        alerts.groupBy(*keys)
        .agg(
            F.max("recent").alias("peak_failures"),
            F.min("second").alias("first"),
            F.max("second").alias("last"),
        )
        .join(wh.users, "user_id")
        .select(
            "username", "department", "is_privileged", "source_ip", "peak_failures",
            moment(F.col("first")).alias("first_alert"),
            moment(F.col("last")).alias("last_alert"),
        )
        .orderBy(F.desc("peak_failures"), "username", "source_ip")
    )


def spray_urgency(wh: Warehouse, threshold: int = 5, since: str | None = FLOOR) -> DataFrame:
    """Addresses by the most users they failed against in an hour, 24 hours and a week.

    → source_ip, users_1h, users_24h, users_7d, urgency. All three periods trail
    each failure, in whole seconds.
    """
    hits = computed_once(
        second_cells(wh.events_since(since).filter(~F.col("success")), "source_ip", "user_id",
                     failures=F.count("*")).drop("failures")
    )
    peaks = None
    for name, seconds in (("users_1h", HOUR), ("users_24h", DAY), ("users_7d", 7 * DAY)):
        found = (
            distinct_trailing(hits, ["source_ip"], "user_id", seconds, name)
            .groupBy("source_ip").agg(F.max(name).alias(name))
        )
        peaks = found if peaks is None else peaks.join(found, "source_ip")
    urgency = (
        F.when(F.col("users_1h") >= threshold, "urgent")
        .when(F.col("users_24h") >= threshold, "high")
        .otherwise("monitor")
    )
    return (
        peaks.filter(F.greatest("users_1h", "users_24h", "users_7d") >= threshold)
        .withColumn("urgency", urgency)
        .orderBy(F.desc("users_1h"), F.desc("users_24h"), F.desc("users_7d"), "source_ip")
    )


def brute_force_by_privilege(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """Brute force with a lower threshold for privileged accounts."""
    threshold = F.when(F.col("is_privileged"), PRIVILEGED_FAILURES).otherwise(REGULAR_FAILURES)
    return brute_force(wh, threshold, since)


def distributed_brute_force(wh: Warehouse, threshold: int = 3, addresses: int = 2,
                            since: str | None = FLOOR, seconds: int = HOUR) -> DataFrame:
    """Users failing from several addresses within any trailing hour.

    → username, failed_attempts and unique_ips (the most at an alert),
    first_alert, last_alert.
    """
    failures = wh.events_since(since).filter(~F.col("success"))
    cells = computed_once(second_cells(failures, "user_id", "source_ip", attempts=F.count("*")))
    counts = trailing(
        cells.groupBy("user_id", "second").agg(F.sum("attempts").alias("attempts")),
        ["user_id"], seconds, "attempts", "failed_attempts",
    )
    reached = distinct_trailing(cells, ["user_id"], "source_ip", seconds, "unique_ips")
    return (
        counts.join(reached, ["user_id", "second"])
        .filter((F.col("failed_attempts") >= threshold) & (F.col("unique_ips") >= addresses))
        .groupBy("user_id")
        .agg(
            F.max("failed_attempts").alias("failed_attempts"),
            F.max("unique_ips").alias("unique_ips"),
            F.min("second").alias("first"), F.max("second").alias("last"),
        )
        .join(wh.users.select("user_id", "username"), "user_id")
        .select(
            "username", "failed_attempts", "unique_ips",
            moment(F.col("first")).alias("first_alert"), moment(F.col("last")).alias("last_alert"),
        )
        .orderBy(F.desc("failed_attempts"), "username")
    )


def logins_after_recent_failures(wh: Warehouse, seconds: int = HOUR, threshold: int = 3,
                                 since: str | None = FLOOR, **join_limits) -> DataFrame:
    """Successes within ``seconds`` after ``threshold`` failures of the user from any address.

    → username, source_ip, successful_login_time, recent_failures. Failures in
    the second of the success do not count.
    """
    events = wh.events_since(since)
    cells = second_cells(
        events, "user_id",
        failures=F.count_if(~F.col("success")), successes=F.count_if("success"),
    )
    alerts = computed_once(
        trailing(cells, ["user_id"], seconds, "failures", "recent_failures", inclusive=False)
        .filter((F.col("successes") > 0) & (F.col("recent_failures") >= threshold))
        .select("user_id", "second", "recent_failures", F.col("successes").alias("weight"))
    )
    successes = events.filter("success").select(
        "event_id", "user_id", "source_ip", "event_timestamp",
        epoch_second(F.col("event_timestamp")).alias("second"),
    )
    keys = ["user_id", "second"]
    matched = lookup_join(
        successes, alerts.select(*keys, "recent_failures"), keys,
        lambda: alerts.select(*keys, "weight"), row_id="event_id", **join_limits,
    )
    return (
        matched.join(wh.users.select("user_id", "username"), "user_id")
        .select(
            "username", "source_ip",
            F.col("event_timestamp").alias("successful_login_time"), "recent_failures",
        )
        .orderBy(F.desc("successful_login_time"), "username", "source_ip")
    )


def session_durations(wh: Warehouse, longest: int = DAY, since: str | None = FLOOR) -> DataFrame:
    """Login to next logout of the same user and host, up to ``longest`` seconds.

    → username, hostname, session_start, duration_seconds. A new login in
    between ends the search.
    """
    keys = ["user_id", "dest_host_id"]
    activity = wh.events_since(since).filter(
        F.col("success") & F.col("dest_host_id").isNotNull()
        & F.col("event_type").isin("login", "logout")
    )
    cells = second_cells(
        activity, *keys,
        logins=F.count_if(F.col("event_type") == "login"),
        logouts=F.count_if(F.col("event_type") == "logout"),
    )
    sessions = following(cells, keys, longest, ["logouts"]).filter(
        (F.col("logins") > 0) & (F.col("next_logouts") > 0)
    )
    hosts = wh.hosts.select(F.col("host_id").alias("dest_host_id"), "hostname")
    return (
        sessions.join(wh.users.select("user_id", "username"), "user_id")
        .join(hosts, "dest_host_id")
        .select(
            "username", "hostname",
            moment(F.col("second")).alias("session_start"),
            (F.col("next_second") - F.col("second")).alias("duration_seconds"),
        )
        .orderBy(F.desc("duration_seconds"), "username", "hostname", "session_start")
    )


def concurrent_addresses(wh: Warehouse, addresses: int = 2, since: str | None = FLOOR,
                         seconds: int = HOUR) -> DataFrame:
    """Users seen from several addresses within any trailing hour.

    → username, unique_ips (the most at an alert), first_alert, last_alert.
    """
    cells = second_cells(wh.events_since(since), "user_id", "source_ip", seen=F.count("*"))
    return (
        distinct_trailing(cells, ["user_id"], "source_ip", seconds, "ips")
        .filter(F.col("ips") >= addresses)
        .groupBy("user_id")
        .agg(
            F.max("ips").alias("unique_ips"),
            F.min("second").alias("first"), F.max("second").alias("last"),
        )
        .join(wh.users.select("user_id", "username"), "user_id")
        .select(
            "username", "unique_ips",
            moment(F.col("first")).alias("first_alert"), moment(F.col("last")).alias("last_alert"),
        )
        .orderBy(F.desc("unique_ips"), "username")
    )
