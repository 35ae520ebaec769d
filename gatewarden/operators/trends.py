"""Trends and profiles: daily series with their gaps, changes between periods, and habits by the hour."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once
from gatewarden.operators import FLOOR
from gatewarden.operators.temporal import IT_DEPARTMENTS
from gatewarden.sources.warehouse import Warehouse

PERIODS = ("week", "month", "quarter", "year")
RISING, FALLING, STEADY = "rising", "falling", "steady"


# --- series -------------------------------------------------------------------------------


def _start(day: Column, period: str) -> Column:
    if period not in PERIODS:
        raise ValueError(f"{period} is none of {', '.join(PERIODS)}")
    return F.to_date(F.date_trunc(period, day))


def address_trends(wh: Warehouse, period: str = "quarter", since: str | None = FLOOR) -> DataFrame:
    """The slope of each external address' daily attempts within a period, days without any as zeros.

    → source_ip, period_start, days, attempts, slope (attempts a day, per day), trend, previous_attempts (of
    the period before, 0 if there were none), change. The series of a period runs over its days
    from the first to the last day of all events.

    A day without events adds nothing to the sums that a least-squares slope is made of but its
    own number, so the gaps are filled by arithmetic instead of rows: the sums over day
    numbers follow from how many days the period has. All of them are whole numbers.
    """
    daily = computed_once(
        wh.events_since(since).groupBy(F.to_date("event_timestamp").alias("day"), "source_ip", "is_external")
        .agg(F.count("*").alias("attempts"))
    )
    ends = daily.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    if ends["first"] is None:
        ends = {"first": date(1970, 1, 1), "last": date(1970, 1, 1)}
    first, last = F.lit(ends["first"]), F.lit(ends["last"])
    start = F.greatest("period_start", first)
    finish = F.least(F.date_add(_next(F.col("period_start"), period), -1), last)
    sums = (
        daily.where("is_external").withColumn("period_start", _start(F.col("day"), period))
        .withColumn("x", F.date_diff("day", start).cast("decimal(12,0)"))
        .groupBy("source_ip", "period_start")
        .agg(F.sum("attempts").alias("attempts"), F.sum(F.col("x") * F.col("attempts")).alias("xy"))
        .withColumn("days", F.date_diff(finish, start) + 1)
    )
    n = F.col("days").cast("decimal(12,0)")
    x1, x2 = n * (n - 1) / 2, (n - 1) * n * (2 * n - 1) / 6
    above = (n * F.col("xy") - x1 * F.col("attempts")).cast("double")
    below = (n * x2 - x1 * x1).cast("double")
    slope = F.when(F.col("days") > 1, above / below)
    # The period after follows at once, or the address has none before.
    own = Window.partitionBy("source_ip").orderBy("period_start")
    before = F.lag(F.struct("period_start", "attempts")).over(own)
    return (
        sums.withColumns({"slope": slope, "before": before})
        .withColumn("previous_attempts", F.when(_next(F.col("before.period_start"), period) == F.col("period_start"), F.col("before.attempts")).otherwise(0))
        .select(
            "source_ip", "period_start", "days", "attempts", "slope",
            F.when(F.col("slope") > 0, RISING).when(F.col("slope") < 0, FALLING).otherwise(STEADY).alias("trend"),
            "previous_attempts", (F.col("attempts") - F.col("previous_attempts")).alias("change"),
        )
        .orderBy(F.desc_nulls_last("slope"), "source_ip", "period_start")
    )


def _next(start: Column, period: str) -> Column:
    if period == "week":
        return F.date_add(start, 7)
    return F.add_months(start, {"month": 1, "quarter": 3, "year": 12}[period])


def period_changes(wh: Warehouse, period: str = "quarter", since: str | None = None) -> DataFrame:
    """Events and failures per period, next to the period before; periods without events are zeros.

    → period_start, event_count, failed_attempts, event_change, failed_change (NULL for the first).
    """
    found = (
        wh.events_since(since).where(F.col("event_timestamp").isNotNull())
        .groupBy(_start(F.to_date("event_timestamp"), period).alias("period_start"))
        .agg(F.count("*").alias("event_count"), F.count_if(~F.col("success")).alias("failed_attempts"))
    )
    found = computed_once(found)
    step = {"week": "7 days", "month": "1 month", "quarter": "3 months", "year": "1 year"}[period]
    all_periods = (
        found.agg(F.min("period_start").alias("a"), F.max("period_start").alias("b")).where("a is not null")
        .select(F.explode(F.expr(f"sequence(a, b, interval {step})")).alias("period_start"))
    )
    in_order = Window.partitionBy().orderBy("period_start")  # one row per period
    counts = ("event_count", "failed_attempts")
    filled = all_periods.join(found, "period_start", "left").select(
        "period_start", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts]
    )
    return filled.select(
        "*", *[(F.col(c) - F.lag(c).over(in_order)).alias(n) for c, n in zip(counts, ("event_change", "failed_change"))]
    ).orderBy("period_start")


# --- calendars that change ----------------------------------------------------------------


def shift_activity_as_of(wh: Warehouse, shifts: DataFrame, holidays: DataFrame, since: str | None = FLOOR) -> DataFrame:
    """Events per shift and holiday, by the shifts that were valid on each day.

    ``shifts`` has valid_from (date), shift and starts_hour: all rows of the latest date up to a day are its
    shifts, and an hour belongs to the shift that started last, before midnight if none has yet.
    ``holidays`` has date and holiday. → shift, holiday, event_count, failed_attempts; shift is NULL before the first version,
    holiday on other days.

    Events collapse to the hours of days first. The versions are found per day, not per event, as an
    as-of join of the two short lists of days.
    """
    hours = computed_once(
        wh.events_since(since).where(F.col("event_timestamp").isNotNull())
        .groupBy(F.to_date("event_timestamp").alias("day"), F.hour("event_timestamp").alias("hour"))
        .agg(F.count("*").alias("events"), F.count_if(~F.col("success")).alias("failures"))
    )
    versions = shifts.select("valid_from").distinct()
    along = Window.partitionBy().orderBy("day", "order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = hours.select("day").distinct().select("day", F.lit(1).alias("order"), F.lit(None).cast("date").alias("version"))
    marks = versions.select(F.col("valid_from").alias("day"), F.lit(0).alias("order"), F.col("valid_from").alias("version"))
    valid = (
        days.unionByName(marks).withColumn("version", F.last("version", ignorenulls=True).over(along))
        .where("order = 1").select("day", "version")
    )
    # The shift of each hour of each version; hours before its first shift belong to its last.
    clock = versions.select("valid_from", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    started = (F.col("starts_hour") <= F.col("hour")).cast("int")
    of_hour = (
        clock.join(shifts, "valid_from")
        .groupBy(F.col("valid_from").alias("version"), "hour")
        .agg(F.max_by("shift", F.struct(started, "starts_hour", "shift")).alias("shift"))
    )
    named = holidays.groupBy(F.col("date").alias("day")).agg(F.min("holiday").alias("holiday"))
    return (
        hours.join(valid, "day").join(of_hour, ["version", "hour"], "left").join(named, "day", "left")
        .groupBy("shift", "holiday")
        .agg(F.sum("events").alias("event_count"), F.sum("failures").alias("failed_attempts"))
        .orderBy("shift", "holiday")
    )


# --- habits -------------------------------------------------------------------------------


def habit_days(events: DataFrame) -> DataFrame:
    """What a day adds to an account's profile: mergeable counts, one row per day, user, kind and value.

    Kinds are hours of the day, addresses, and hosts. → day, user_id, kind, value, events.
    """
    cells = events.groupBy(
        F.to_date("event_timestamp").alias("day"), "user_id", F.hour("event_timestamp").alias("hour"), "source_ip", "dest_host_id"
    ).agg(F.count("*").alias("events"))
    hour = F.col("hour").cast("string")
    values = F.array(*[
        F.struct(F.lit(kind).alias("kind"), value.alias("value"))
        for kind, value in (("hour", hour), ("address", F.col("source_ip")), ("host", F.col("dest_host_id").cast("string")))
    ])
    return (
        cells.select("day", "user_id", "events", F.inline(values)).where(F.col("value").isNotNull())
        .groupBy("day", "user_id", "kind", "value").agg(F.sum("events").alias("events"))
    )


def unusual_days(wh: Warehouse, as_of: str, days: int = 30, least_before: int = 10, distance: float = 0.5,
                 habits: DataFrame | None = None) -> DataFrame:
    """Accounts whose day differs from their ``days`` days before it, by hours, addresses or hosts.

    → username, department, events_today, events_before, hour_distance, new_hours, new_addresses, new_hosts, flags.
    ``hour_distance`` is half the summed difference of the two days' shares of each hour: 0 for the same
    hours, 1 for none in common. An account counts with ``least_before`` events before.
    ``habits`` may be the stored ``habit_days``; then no event is read.
    """
    today = F.lit(date.fromisoformat(as_of))
    parts = habit_days(wh.events) if habits is None else habits
    near = parts.where((F.col("day") <= today) & (F.col("day") >= F.date_sub(today, days)))
    is_today = F.col("day") == today
    profile = computed_once(
        near.groupBy("user_id", "kind", "value").agg(
            F.sum(F.when(is_today, F.col("events")).otherwise(0)).alias("now"),
            F.sum(F.when(~is_today, F.col("events")).otherwise(0)).alias("before"),
        )
    )
    totals = profile.where("kind = 'hour'").groupBy("user_id").agg(
        F.sum("now").alias("events_today"), F.sum("before").alias("events_before")
    ).where((F.col("events_today") > 0) & (F.col("events_before") >= least_before))
    # In whole numbers up to the last division, whatever the order of the sums.
    apart = F.abs(F.col("now") * F.col("events_before") - F.col("before") * F.col("events_today"))
    new = (F.col("now") > 0) & (F.col("before") == 0)
    judged = (
        profile.join(totals, "user_id")
        .groupBy("user_id", "events_today", "events_before")
        .agg(
            F.sum(F.when(F.col("kind") == "hour", apart)).alias("apart"),
            *[F.count_if(new & (F.col("kind") == k)).alias(n)
              for k, n in (("hour", "new_hours"), ("address", "new_addresses"), ("host", "new_hosts"))],
        )
        .withColumn("hour_distance", F.col("apart").cast("double") / (2 * F.col("events_today") * F.col("events_before")).cast("double"))
    )
    outside_it = F.coalesce(~F.col("department").isin(*IT_DEPARTMENTS), F.lit(True))
    rules = {
        "unusual_hours": (F.col("new_hours") > 0) & (F.col("hour_distance") >= distance),
        "new_addresses": F.col("new_addresses") >= 3,
        "new_hosts": (F.col("new_hosts") >= 3) & outside_it,
    }
    flags = F.array_compact(F.array(*[F.when(rule, name) for name, rule in rules.items()]))
    return (
        judged.join(wh.users, "user_id").withColumn("found", flags).where(F.size("found") > 0)
        .select(
            "username", "department", "events_today", "events_before", "hour_distance", "new_hours", "new_addresses",
            "new_hosts", F.array_join("found", ", ").alias("flags"),
        )
        .orderBy(F.desc("hour_distance"), "username")
    )
