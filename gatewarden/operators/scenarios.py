"""Scenario classes of events, and the headline counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.clock import day_of_week
from gatewarden.functions.shared import computed_once
from gatewarden.functions.skew import lookup_join
from gatewarden.operators import FLOOR
from gatewarden.sources.warehouse import Warehouse

# Class names, and the account id of the service account.
PASSWORD_SPRAYING = "Password Spraying"
BRUTE_FORCE = "Brute Force"
SERVICE_ACCOUNT = "Service Account"
NORMAL_ACTIVITY = "Normal Activity"
OTHER = "Other"
SERVICE_ACCOUNT_ID = 11

# The class's own working day, one hour longer than the calendar's.
OFFICE_HOURS = (8, 18)
OFFICE_DAYS = (1, 5)


def pair_rollup(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """The whole fact table in one pass, one row per (user, address).

    ``ever_*`` counts ignore the floor; all others apply it. The report parts
    are functions of this rollup, so the events are scanned once.
    """
    when, failed = F.col("event_timestamp"), ~F.col("success")
    current = F.lit(True) if since is None else when >= F.lit(since).cast("timestamp_ntz")
    office = F.hour(when).between(*OFFICE_HOURS) & day_of_week(when).between(*OFFICE_DAYS)
    return wh.events.groupBy("user_id", "source_ip", "is_external").agg(
        F.count_if(failed).alias("ever_failed"),
        F.count_if(~failed).alias("ever_succeeded"),
        F.count_if(current).alias("events"),
        F.count_if(current & failed).alias("failures"),
        F.count_if(current & ~failed).alias("successes"),
        F.count_if(current & office).alias("office_events"),
        F.count_if(current & office & failed).alias("office_failures"),
        F.min(F.when(current & failed, when)).alias("first_failure"),
        F.max(F.when(current & failed, when)).alias("last_failure"),
    )


def scenario_classification(wh: Warehouse, since: str | None = FLOOR, spray_users: int = 5,
                            brute_failures: int = 3, service_account: int = SERVICE_ACCOUNT_ID,
                            rollup: DataFrame | None = None, **join_limits) -> DataFrame:
    """Events per scenario → scenario, event_count, failed_count, success_count.

    Whether an address sprays is only known once all its users are counted. A
    pair therefore votes with the class it has otherwise, votes are summed per
    address, and a spraying address takes all its votes. Only the user test
    needs a join.
    """
    if rollup is None:
        rollup = computed_once(pair_rollup(wh, since))
    forced = (
        rollup.filter(F.col("ever_failed") >= brute_failures)
        .select("user_id", F.lit(True).alias("brute_forced"))
        .distinct()
    )
    flagged = lookup_join(
        rollup,
        forced,
        ["user_id"],
        lambda: rollup.groupBy("user_id").agg(F.count("*").alias("weight")),
        row_id="source_ip",
        how="left",
        **join_limits,
    )
    settled = F.when(F.col("brute_forced") & F.col("is_external"), BRUTE_FORCE).when(
        F.col("user_id") == service_account, SERVICE_ACCOUNT
    )
    in_office = F.coalesce(
        settled, F.when(~F.col("is_external"), NORMAL_ACTIVITY).otherwise(OTHER)
    )
    votes = flagged.select(
        "source_ip",
        (F.col("ever_failed") > 0).alias("user_failed"),
        F.inline(
            F.array(
                F.struct(
                    in_office.alias("scenario"),
                    F.col("office_events").alias("event_count"),
                    F.col("office_failures").alias("failed_count"),
                ),
                F.struct(
                    F.coalesce(settled, F.lit(OTHER)).alias("scenario"),
                    (F.col("events") - F.col("office_events")).alias("event_count"),
                    (F.col("failures") - F.col("office_failures")).alias("failed_count"),
                ),
            )
        ),
    )
    per_address = votes.groupBy("source_ip").agg(
        # every pair votes twice, in office time and outside it
        (F.count_if("user_failed") >= 2 * spray_users).alias("sprays"),
        *[
            F.sum(F.when(F.col("scenario") == name, F.col(count)).otherwise(0)).alias(
                f"{count}_{i}"
            )
            for i, name in enumerate(_UNSETTLED)
            for count in ("event_count", "failed_count")
        ],
    )
    named = per_address.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.when(F.col("sprays"), PASSWORD_SPRAYING).otherwise(name)
                        .alias("scenario"),
                        F.col(f"event_count_{i}").alias("event_count"),
                        F.col(f"failed_count_{i}").alias("failed_count"),
                    )
                    for i, name in enumerate(_UNSETTLED)
                ]
            )
        )
    )
    return (
        named.groupBy("scenario")
        .agg(
            F.sum("event_count").alias("event_count"),
            F.sum("failed_count").alias("failed_count"),
        )
        .filter(F.col("event_count") > 0)
        .withColumn("success_count", F.col("event_count") - F.col("failed_count"))
        .orderBy(F.desc("event_count"), "scenario")
    )


_UNSETTLED = (BRUTE_FORCE, SERVICE_ACCOUNT, NORMAL_ACTIVITY, OTHER)


def kpi_summary(wh: Warehouse, since: str | None = FLOOR) -> DataFrame:
    """→ total_events, failed_logins, successful_logins, external_ips, in one pass."""
    return wh.events_since(since).agg(
        F.count("*").alias("total_events"),
        F.count_if(~F.col("success")).alias("failed_logins"),
        F.count_if("success").alias("successful_logins"),
        F.countDistinct(F.when(F.col("is_external"), F.col("source_ip"))).alias("external_ips"),
    )
