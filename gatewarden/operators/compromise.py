"""Successful logins that follow repeated failures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewarden.functions.clock import epoch_second
from gatewarden.functions.shared import computed_once
from gatewarden.functions.skew import BROADCAST_BYTES, data_bytes, lookup_join
from gatewarden.sources.warehouse import Warehouse

COLUMNS = (
    "username", "department", "is_privileged", "failure_count", "last_failure",
    "successful_login_time", "source_ip", "target_host", "asset_criticality",
)


def pair_history(events: DataFrame) -> DataFrame:
    """Failures and successes per (user, address) in one pass."""
    when, success = F.col("event_timestamp"), F.col("success")
    failed = ~success
    return events.groupBy("user_id", "source_ip").agg(
        F.count_if(failed).alias("failure_count"),
        F.max(F.when(failed, when)).alias("last_failure"),
        F.count_if(success).alias("success_count"),
        F.max(F.when(success, when)).alias("last_success"),
    )


def compromised_same_address(wh: Warehouse, threshold: int = 3, keep_unknown_hosts: bool = False,
                             failed_after: str | Column | None = None,
                             **join_limits) -> DataFrame:
    """Every success of a (user, address) later than the last of its failures.

    The history is computed once and keeps only pairs that really have such a
    success, so the success rows usually meet a lookup short enough to
    broadcast and are not shuffled at all. ``failed_after`` restricts the
    failures counted; a success has to be later still, so both scans skip
    everything before it.
    """
    keys = ["user_id", "source_ip"]
    events = wh.events_after(failed_after)
    suspects = computed_once(
        pair_history(events).filter(
            (F.col("failure_count") >= threshold)
            & (F.col("last_success") > F.col("last_failure"))
        )
    )
    matches = lookup_join(
        _successes(events),
        suspects.select(*keys, "failure_count", "last_failure"),
        keys,
        lambda: suspects.select(*keys, F.col("success_count").alias("weight")),
        row_id="event_id",
        **join_limits,
    )
    return _report(wh, matches, keep_unknown_hosts)


#: Marks of a user up to which they travel with the user's name.
MARKS = 256


def compromised_any_address(wh: Warehouse, threshold: int = 3, keep_unknown_hosts: bool = False,
                            broadcast_bytes: int = BROADCAST_BYTES, most_marks: int = MARKS) -> DataFrame:
    """Every success of a user later than the last failure from some failing address.

    One row per success, from whatever address: how many failing addresses it
    follows (``failing_addresses``), their failures, and the latest of their
    last failures. The addresses are added up along the user's time, once per
    moment at which one falls silent (a mark), and a success looks up the
    latest mark before it. Users with few marks take them along to wherever
    the successes lie, so those are not shuffled; the successes of users with
    many marks, or of all if the marks are long together, are put in order with the marks.
    """
    marks = computed_once(
        wh.events.filter(~F.col("success"))
        .groupBy("user_id", "source_ip")
        .agg(F.count("*").alias("failures"), F.max("event_timestamp").alias("at"))
        .filter(F.col("failures") >= threshold)
        .groupBy("user_id", "at")
        .agg(F.count("*").alias("addresses"), F.sum("failures").alias("failures"))
    )
    few = marks.groupBy("user_id").agg(F.count("*").alias("marks")).filter(F.col("marks") <= most_marks)
    if data_bytes(marks) > broadcast_bytes:
        few = few.limit(0)
    few = computed_once(few.select("user_id"))
    parts = [_looked_up(wh, marks.join(few, "user_id"))]
    rest = computed_once(marks.join(few, "user_id", "left_anti"))
    if not rest.isEmpty():
        parts.append(_put_in_order(wh, rest))
    return _report(wh, reduce(DataFrame.unionByName, parts), keep_unknown_hosts, "failing_addresses")


_FOLLOWED = (
    "event_id", "user_id", "source_ip", "dest_host_id", "event_timestamp", "failing_addresses", "failure_count", "last_failure",
)


def _looked_up(wh: Warehouse, marks: DataFrame) -> DataFrame:
    """Successes with the latest mark before them, from a broadcast of all marks given."""
    so_far = Window.partitionBy("user_id").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = marks.select(
        "user_id",
        F.struct(
            F.col("at").alias("last_failure"), F.sum("addresses").over(so_far).alias("failing_addresses"),
            F.sum("failures").over(so_far).alias("failure_count"),
        ).alias("mark"),
    )
    listed = summed.groupBy("user_id").agg(F.array_sort(F.collect_list("mark")).alias("marks"))  # at most MARKS
    earlier = F.filter("marks", lambda m: m["last_failure"] < F.col("event_timestamp"))
    return (
        _successes(wh.events).join(F.broadcast(listed), "user_id")  # measured by the caller
        .withColumn("mark", F.try_element_at(earlier, F.lit(-1)))
        .filter(F.col("mark").isNotNull())
        .select("*", "mark.*").select(*_FOLLOWED)
    )


def _put_in_order(wh: Warehouse, marks: DataFrame) -> DataFrame:
    """Successes with the sums of the marks before them, by shuffling both along the user's time."""
    own = marks.select(
        "user_id", "at", F.lit(1).alias("kind"), "addresses", "failures", F.col("at").alias("last_failure")
    )
    successes = (
        _successes(wh.events)
        .join(marks.select("user_id").distinct(), "user_id", "left_semi")
        .withColumnRenamed("event_timestamp", "at")
        .withColumn("kind", F.lit(0))
    )
    timeline = computed_once(successes.unionByName(own, allowMissingColumns=True).withColumn(
        "minute", F.floor(epoch_second(F.col("at")) / 60)
    ))
    followed = _followed(timeline).filter((F.col("kind") == 0) & (F.col("failing_addresses") > 0))
    return followed.withColumnRenamed("at", "event_timestamp").select(*_FOLLOWED)


def _followed(timeline: DataFrame) -> DataFrame:
    """Add the sums of the marks strictly before each row of a user.

    Time is cut into minutes. Sums within a minute and sums of the minutes
    before are taken apart, so a window holds the rows of one minute or one row
    per minute, whatever the user.
    """
    sums = {
        "failing_addresses": lambda: F.sum("addresses"),
        "failure_count": lambda: F.sum("failures"),
        "last_failure": lambda: F.max("last_failure"),
    }
    # A success comes before the marks of its own moment.
    within = Window.partitionBy("user_id", "minute").orderBy("at", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before = Window.partitionBy("user_id").orderBy("minute").rowsBetween(
        Window.unboundedPreceding, -1
    )
    minutes = timeline.groupBy("user_id", "minute").agg(
        F.sum("addresses").alias("addresses"), F.sum("failures").alias("failures"),
        F.max("last_failure").alias("last_failure"),
    )
    earlier = minutes.select(
        "user_id", "minute", *[make().over(before).alias(f"{name}_before") for name, make in sums.items()]
    )
    here = timeline.withColumns({f"{name}_here": make().over(within) for name, make in sums.items()})
    joined = here.join(earlier, ["user_id", "minute"])
    total = {
        name: F.coalesce(F.col(f"{name}_before"), F.lit(0)) + F.coalesce(F.col(f"{name}_here"), F.lit(0))
        for name in ("failing_addresses", "failure_count")
    }
    latest = F.coalesce("last_failure_here", "last_failure_before")
    return joined.drop("failures", "addresses", "last_failure").withColumns(
        {**total, "last_failure": latest}
    )


def _successes(events: DataFrame) -> DataFrame:
    return events.filter("success").select(
        "event_id", "user_id", "source_ip", "dest_host_id", "event_timestamp"
    )


def _report(wh: Warehouse, matches: DataFrame, keep_unknown_hosts: bool,
            *more: str) -> DataFrame:
    hosts = wh.hosts.select(
        F.col("host_id").alias("dest_host_id"),
        F.col("hostname").alias("target_host"),
        "asset_criticality",
    )
    return (
        matches.filter(F.col("event_timestamp") > F.col("last_failure"))
        .join(wh.users, "user_id")
        .join(hosts, "dest_host_id", "left" if keep_unknown_hosts else "inner")
        .withColumnRenamed("event_timestamp", "successful_login_time")
        .select(*COLUMNS, *more)
        .orderBy(F.desc("successful_login_time"), "username", "source_ip", "last_failure")
    )
