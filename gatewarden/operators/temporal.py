"""When attacks happen: hours, working time, weekdays, nights.

The calendar's flags depend only on the weekday and the hour, so most jobs
first collapse the events to the 168 hours of a week and label those.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewarden.functions.clock import HIGH_RISK, Calendar, hour_of
from gatewarden.functions.numbers import percent
from gatewarden.functions.severity import heat_level
from gatewarden.functions.shared import computed_once
from gatewarden.functions.text import joined_members, short_stamp
from gatewarden.operators import FLOOR
from gatewarden.sources.warehouse import Warehouse

# Departments whose night work is expected.
IT_DEPARTMENTS = ("IT Security", "IT Ops", "IT Support")


def hour_cells(wh: Warehouse, since: str | None, *keys: str) -> DataFrame:
    """Events, failures and successes per weekday, hour and the extra keys."""
    return (
        wh.calendar.place(wh.events_since(since))
        .groupBy("day_of_week", "hour", *keys)
        .agg(
            F.count("*").alias("events"),
            F.count_if(~F.col("success")).alias("failures"),
            F.count_if("success").alias("successes"),
        )
    )


def week_cells(wh: Warehouse, since: str | None, cells: DataFrame | None = None) -> DataFrame:
    """Events per weekday and hour, labelled (at most 168 rows); ``cells`` may be finer ones."""
    if cells is None:
        found = hour_cells(wh, since)
    else:
        found = cells.groupBy("day_of_week", "hour").agg(
            *[F.sum(name).alias(name) for name in ("events", "failures", "successes")]
        )
    return wh.calendar.with_flags(found)


def attacks_by_hour(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """Failures per (hour, is_business_hours, risk_period) with their share of all."""
    everything = Window.partitionBy()  # over at most 48 grouped rows
    return (
        hourly_attacks(wh, since)
        .select(
            "hour",
            "attack_count",
            "is_business_hours",
            "risk_period",
            percent(F.col("attack_count"), F.sum("attack_count").over(everything)).alias(
                "percent_of_total"
            ),
        )
        .orderBy(F.desc("attack_count"), "hour", "is_business_hours")
    )


def hourly_attacks(wh: Warehouse, since: str | None = FLOOR,
                   cells: DataFrame | None = None) -> DataFrame:
    """Failures per (hour, is_business_hours, risk_period) in hour order."""
    return (
        week_cells(wh, since, cells)
        .filter(F.col("failures") > 0)
        .groupBy("hour", "is_business_hours", "risk_period")
        .agg(F.sum("failures").alias("attack_count"))
        .select("hour", "attack_count", "is_business_hours", "risk_period")
        .orderBy("hour", "is_business_hours")
    )


def _working_time(wh: Warehouse, cells: DataFrame, column: str, name: str) -> DataFrame:
    """Per is_business_hours: events, successes, and the distinct values of a column.

    ``cells`` are hour cells with that column. Values are counted as rows of a
    group-by, so the two groups are only merged from counts.
    """
    flag = wh.calendar.is_business_hours(F.col("day_of_week"), F.col("hour"))
    return (
        cells.groupBy(flag.alias("is_business_hours"), column)
        .agg(F.sum("events").alias("events"), F.sum("successes").alias("successes"))
        .groupBy("is_business_hours")
        .agg(
            F.sum("events").alias("total_attacks"),
            F.sum("successes").alias("successful_attempts"),
            F.count("*").alias(name),
        )
    )


def business_hours_comparison(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """All events inside and outside business hours, with the success rate."""
    cells = computed_once(hour_cells(wh, since, "user_id", "source_ip"))
    targets = _working_time(wh, cells, "user_id", "unique_targets")
    return (
        _working_time(wh, cells, "source_ip", "unique_attackers")
        .join(targets.select("is_business_hours", "unique_targets"), "is_business_hours")
        .select(
            "is_business_hours", "total_attacks", "unique_attackers", "unique_targets",
            percent(F.col("successful_attempts"), F.col("total_attacks")).alias(
                "success_rate_percent"
            ),
        )
        .orderBy(F.desc("is_business_hours"))
    )


def business_hours_dashboard(wh: Warehouse, since: str | None = FLOOR,
                             cells: DataFrame | None = None) -> DataFrame:
    """The same two rows under a label, with the number of successes."""
    if cells is None:
        cells = hour_cells(wh, since, "source_ip")
    period = F.when(F.col("is_business_hours"), "Business Hours").otherwise("Off-Hours")
    return (
        _working_time(wh, cells, "source_ip", "unique_attackers")
        .select(
            period.alias("period"), "total_attacks", "unique_attackers", "successful_attempts"
        )
        .orderBy("period")
    )


def day_of_week_pattern(wh: Warehouse, since: str | None = FLOOR,
                        cells: DataFrame | None = None) -> DataFrame:
    """Events, failures and successes per weekday, Sunday first."""
    return (
        week_cells(wh, since, cells)
        .groupBy("day_name", "is_weekend", "day_of_week")
        .agg(
            F.sum("events").alias("event_count"),
            F.sum("failures").alias("failed_attempts"),
            F.sum("successes").alias("successful_logins"),
        )
        .orderBy("day_of_week")
        .drop("day_of_week")
    )


def day_of_week_dashboard(wh: Warehouse, since: str | None = FLOOR,
                          cells: DataFrame | None = None) -> DataFrame:
    return day_of_week_pattern(wh, since, cells).drop("successful_logins")


def high_risk_period_attacks(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """Failures in high-risk hours per (address, user) with the minutes they happened.

    Events collapse to minutes before they are listed, so a list is bounded by
    the minutes of the period.
    """
    calendar = wh.calendar
    risky = (calendar.risk_period(F.col("day_of_week"), F.col("hour")) == HIGH_RISK)
    minutes = (
        calendar.place(wh.events_since(since).filter(~F.col("success")))
        .filter(risky)
        .groupBy("source_ip", "user_id", short_stamp(F.col("event_timestamp")).alias("minute"))
        .agg(F.count("*").alias("attempts"))
    )
    return (
        minutes.groupBy("source_ip", "user_id")
        .agg(
            F.sum("attempts").alias("attack_count"),
            joined_members(F.col("minute")).alias("attack_times"),
        )
        .join(wh.users.select("user_id", "username"), "user_id")
        .select(
            "source_ip", "username", F.lit(HIGH_RISK).alias("risk_period"),
            "attack_count", "attack_times",
        )
        .orderBy(F.desc("attack_count"), "source_ip", "username")
    )


def _night_logins(wh: Warehouse, since: str | None) -> DataFrame:
    placed = wh.calendar.place(wh.events_since(since).filter("success"))
    return placed.filter(wh.calendar.is_night_shift(F.col("hour")))


def night_shift_anomalies(wh: Warehouse, since: str | None = FLOOR,
                          expected: tuple[str, ...] = IT_DEPARTMENTS) -> DataFrame:
    """Night logins of users outside the expected departments (a NULL department drops out)."""
    users = wh.users.filter(~F.col("department").isin(*expected))
    return (
        _night_logins(wh, since)
        .groupBy("user_id")
        .agg(
            F.count("*").alias("night_logins"),
            F.min("event_timestamp").alias("first_night_login"),
            F.max("event_timestamp").alias("last_night_login"),
        )
        .join(users, "user_id")
        .select(
            "username", "department", "is_privileged", "night_logins",
            "first_night_login", "last_night_login",
        )
        .orderBy(F.desc("night_logins"), "username")
    )


def hourly_heatmap(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """Failures per weekday and hour with a level."""
    return (
        week_cells(wh, since)
        .filter(F.col("failures") > 0)
        .orderBy("day_of_week", "hour")
        .select(
            "day_name", "hour", F.col("failures").alias("attack_count"),
            heat_level(F.col("failures")).alias("severity"),
        )
    )


def _events_with_time(wh: Warehouse, events: DataFrame) -> DataFrame:
    return wh.calendar.with_flags(wh.calendar.place(events))


def privileged_off_hours(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """Privileged events outside business hours, newest first; the host may be unknown."""
    users = wh.users.filter("is_privileged").select("user_id", "username", "department")
    hosts = wh.hosts.select(F.col("host_id").alias("dest_host_id"), "hostname")
    return (
        _events_with_time(wh, wh.events_since(since))
        .filter(~F.col("is_business_hours"))
        .join(users, "user_id")
        .join(hosts, "dest_host_id", "left")
        .orderBy(F.desc("event_timestamp"), F.desc("event_id"))
        .select(
            "username", "department", "hostname", "event_timestamp", "day_name",
            "hour", "risk_period", "source_ip", "success",
        )
    )


DETAIL = (
    "event_id", "user_id", "dest_host_id", "source_ip", "event_type", "success",
    "event_timestamp", "username", "department", "is_privileged", "full_timestamp",
    "date", "day_of_week", "day_name", "hour", "is_weekend", "is_business_hours",
    "is_night_shift", "risk_period",
)


def _detail(wh: Warehouse, events: DataFrame, users: DataFrame) -> DataFrame:
    """Event, user and hour columns side by side."""
    at = F.col("event_timestamp")
    return (
        _events_with_time(wh, events)
        .withColumns({"full_timestamp": hour_of(at), "date": F.to_date(at)})
        .join(users, "user_id")
        .select(*DETAIL)
    )


def privileged_off_hours_detail(wh: Warehouse, since: str | None = None) -> DataFrame:
    """All columns of privileged events outside business hours."""
    users = wh.users.filter("is_privileged")
    return _detail(wh, wh.events_since(since), users).filter(~F.col("is_business_hours"))


def department_night_logins(wh: Warehouse, department: str = "Finance",
                            since: str | None = None) -> DataFrame:
    """All columns of one department's successful night events."""
    users = wh.users.filter(F.col("department") == department)
    successes = wh.events_since(since).filter("success")
    return _detail(wh, successes, users).filter("is_night_shift")


def spray_by_hour(wh: Warehouse, threshold: int = 5, since: str | None = None) -> DataFrame:
    """Hours of the day in which ``threshold`` users or more had failures."""
    return (
        wh.calendar.place(wh.events_since(since).filter(~F.col("success")))
        .groupBy("hour")
        .agg(
            F.count("*").alias("attack_count"),
            F.countDistinct("user_id").alias("users_targeted"),
        )
        .filter(F.col("users_targeted") >= threshold)
        .orderBy("hour")
    )


def events_by_calendar_join(wh: Warehouse, hours: DataFrame,
                            since: str | None = FLOOR) -> DataFrame:
    """Events joined to a stored hour dimension, for calendars edited by hand.

    The dimension has one row per hour, so its size follows the years covered,
    not the events; Spark checks it before choosing a broadcast.
    """
    events = wh.events_since(since).withColumn(
        "full_timestamp", hour_of(F.col("event_timestamp"))
    )
    return events.join(hours, "full_timestamp")


def calendar_of(wh: Warehouse) -> DataFrame:
    """Hour dimension sized from the data: whole days from the first event to the last.

    Its rows are made by as many tasks as the session likes. Hours are numbered
    from the calendar's first day if it has one, else from the first event's.
    """
    span = wh.calendar.spanning(wh.events)
    if span is None:
        return Calendar.of_year(1970).table(wh.spark).limit(0)
    hours = span.table(wh.spark).select("full_timestamp")
    return replace(span, first_day=wh.calendar.first_day or span.first_day).describe(hours)


def calendar_span(hours: DataFrame) -> DataFrame:
    """→ total_hours, earliest, latest."""
    return hours.agg(
        F.count("*").alias("total_hours"),
        F.min("full_timestamp").alias("earliest"),
        F.max("full_timestamp").alias("latest"),
    )


def calendar_day(hours: DataFrame, day: str = "2025-01-20", rows: int = 10) -> DataFrame:
    """The first hours of one day."""
    return (
        hours.filter(F.col("date") == F.lit(day).cast("date"))
        .orderBy("hour")
        .limit(rows)
        .select(
            "full_timestamp", "day_name", "hour", "is_weekend", "is_business_hours",
            "is_night_shift", "risk_period",
        )
    )
