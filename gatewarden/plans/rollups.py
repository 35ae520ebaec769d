"""Stored daily rollups: reports are kept up to date by what each load brings.

A load writes three small tables next to its facts, by day: outcomes per (user, address), failures
per (host, address), and mergeable distinct state of what those do not hold: the users of an address
are its pairs. A load that runs again replaces its own parts. Reading merges the parts of all loads and days asked for, so a report never scans the
events again, however many loads there were.

A day's rollup cannot be cut, so floors are days.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gatewarden.functions.clock import Calendar, day_of_week
from gatewarden.functions.distincts import distinct_state, member_rows, merged_distincts
from gatewarden.functions.numbers import percent
from gatewarden.functions.shared import computed_once, side_by_side
from gatewarden.operators.scenarios import OFFICE_DAYS, OFFICE_HOURS, scenario_classification
from gatewarden.plans.dashboard import dashboard_document
from gatewarden.plans.executive import executive_dashboard
from gatewarden.sources.warehouse import Warehouse

#: Look-backs in days: a day, a week, a quarter.
PERIODS = (1, 7, 91)
PAIRS, HOSTS, DISTINCTS = "rollup_pairs", "rollup_hosts", "rollup_distincts"

# What a row of distinct state counts.
TARGET_HOSTS = "hosts of address"
ATTACKERS, TARGETS = "addresses by working time", "users by working time"

#: Events of a day from which its parts of a load are more than one file.
EVENTS_PER_FILE = 500_000


def pair_days(events: DataFrame, calendar: Calendar) -> DataFrame:
    """Outcomes per day, user, address, office time and working time."""
    when, failed = F.col("event_timestamp"), ~F.col("success")
    hour, dow = F.hour(when), day_of_week(when)
    return events.groupBy(
        F.to_date(when).alias("event_date"), "user_id", "source_ip", "source_ip_num", "is_external",
        (hour.between(*OFFICE_HOURS) & dow.between(*OFFICE_DAYS)).alias("office"),
        calendar.is_business_hours(dow, hour).alias("business"), calendar.covers(when).alias("covered"),
    ).agg(
        F.count("*").alias("events"), F.count_if(failed).alias("failures"),
        F.min(F.when(failed, when)).alias("first_failure"), F.max(F.when(failed, when)).alias("last_failure"),
        F.min(when).alias("first_seen"), F.max(when).alias("last_seen"),
    )


def host_days(events: DataFrame) -> DataFrame:
    """Events and failures, if any, per day, host (which may be unknown) and address."""
    return (
        events.groupBy(
            F.to_date("event_timestamp").alias("event_date"), F.col("dest_host_id").alias("host_id"), "source_ip", "is_external"
        )
        .agg(F.count("*").alias("events"), F.count_if(~F.col("success")).alias("failures"))
    )


def distinct_days(pairs: DataFrame, hosts: DataFrame) -> DataFrame:
    """event_date, what, subject, and the distinct state of each; the pairs are the users of an address."""
    def members(rows: DataFrame, what: str, subject: Column, member: str, text: str | None = None) -> DataFrame:
        return rows.select(
            "event_date", F.lit(what).alias("what"), subject.cast("string").alias("subject"),
            F.col(member).alias("member"), (F.col(text) if text else F.lit(None).cast("string")).alias("text"),
        )

    covered = pairs.where("covered")
    cells = (
        members(hosts.where("is_external"), TARGET_HOSTS, F.col("source_ip"), "host_id")
        .unionByName(members(covered, ATTACKERS, F.col("business"), "source_ip_num", "source_ip"))
        .unionByName(members(covered, TARGETS, F.col("business"), "user_id"))
    )
    return distinct_state(cells, ["event_date", "what", "subject"], "member", "text")


def write_rollups(events: DataFrame, path: str, load: str, calendar: Calendar | None = None) -> None:
    """Add a load's parts to the rollups at ``path``, or replace those it wrote before.

    ``events`` are the load's, with their stored columns; only they are read, twice. The pairs, which
    may be nearly as many, are written once: their distinct state comes from where they are stored.
    """
    hosts, pairs = computed_once(host_days(events)), pair_days(events, calendar or Calendar())
    days = hosts.groupBy("event_date").agg(F.sum("events").alias("events")).collect()  # one row a day
    if not days:
        return
    files = _files(hosts, days)
    failures = hosts.where("failures > 0").drop("is_external", "events")
    _write_parts(pairs, ["user_id", "source_ip"], files, f"{path}/{PAIRS}", load)
    _write_parts(failures, ["host_id", "source_ip"], files, f"{path}/{HOSTS}", load)
    stored = _stored_pairs(pairs, [row["event_date"] for row in days], path, load)
    _write_parts(distinct_days(stored, hosts), ["subject", "bucket", "text"], files, f"{path}/{DISTINCTS}", load)


def _files(hosts: DataFrame, days: list[Row]) -> tuple[DataFrame, int]:
    """Per event_date the ``first`` and the number of its ``files``, and the number of all: they follow from the
    events of each day, not from settings or estimates of sizes."""
    files = [-(-row["events"] // EVENTS_PER_FILE) for row in days]
    firsts = [0, *accumulate(files)]
    rows = [(row["event_date"], first, n) for row, first, n in zip(days, firsts, files)]
    return hosts.sparkSession.createDataFrame(rows, "event_date date, first int, files int"), firsts[-1]


def _write_parts(parts: DataFrame, spread: list[str], files: tuple[DataFrame, int], folder: str, load: str) -> None:
    """Each file is written by one task; a day's rows are dealt to its files by the columns of ``spread``."""
    per_day, n = files
    per_day = F.broadcast(per_day.withColumnRenamed("event_date", "day"))  # one row a day
    file = F.col("first") + F.pmod(F.xxhash64(*spread), F.col("files")).cast("int")
    (
        parts.join(per_day, F.col("event_date").eqNullSafe(F.col("day"))).withColumn("file", file)
        .repartitionById(n, "file").drop("day", "first", "files", "file").withColumn("load", F.lit(load))
        .write.partitionBy("event_date", "load").mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").parquet(folder)
    )


def _stored_pairs(pairs: DataFrame, days: list[date | None], path: str, load: str) -> DataFrame:
    """The pairs as the load has just stored them; only the folders of its days are listed."""
    folder = f"{path}/{PAIRS}"
    names = ["__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat() for day in days]
    stored = (
        pairs.sparkSession.read.schema(pairs.withColumn("load", F.lit(load)).schema).option("basePath", folder)
        .parquet(*[f"{folder}/event_date={name}" for name in names])
    )
    return stored.where(F.col("load") == load).select(pairs.columns)


@dataclass(frozen=True)
class Rollups:
    """The stored parts of all loads."""

    pairs: DataFrame
    hosts: DataFrame
    distincts: DataFrame

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Rollups:
        return cls(*(spark.read.parquet(f"{path}/{name}").drop("load") for name in (PAIRS, HOSTS, DISTINCTS)))

    def pair_rollup(self, since: str | None) -> DataFrame:
        """What ``scenarios.pair_rollup`` gives of the events: the reports' input."""
        current, office = _from_day(since), F.col("office")

        def total(condition: Column, amount: str) -> Column:
            return F.sum(F.when(condition, F.col(amount)).otherwise(0))

        succeeded = F.col("events") - F.col("failures")
        return self.pairs.groupBy("user_id", "source_ip", "is_external").agg(
            F.sum("failures").alias("ever_failed"), F.sum(succeeded).alias("ever_succeeded"),
            total(current, "events").alias("events"), total(current, "failures").alias("failures"),
            F.sum(F.when(current, succeeded).otherwise(0)).alias("successes"),
            total(current & office, "events").alias("office_events"),
            total(current & office, "failures").alias("office_failures"),
            F.min(F.when(current, F.col("first_failure"))).alias("first_failure"),
            F.max(F.when(current, F.col("last_failure"))).alias("last_failure"),
        )

    def failures_by_host_and_day(self, since: str | None) -> DataFrame:
        """host_id, day, failures."""
        return (
            self.hosts.where(_from_day(since)).groupBy("host_id", F.col("event_date").alias("day"))
            .agg(F.sum("failures").alias("failures"))
        )

    def failures_by_host_and_address(self, since: str | None) -> DataFrame:
        """host_id, source_ip, attempts, of known hosts."""
        return (
            self.hosts.where(_from_day(since) & F.col("host_id").isNotNull()).groupBy("host_id", "source_ip")
            .agg(F.sum("failures").alias("attempts"))
        )

    def distinct_counts(self, what: str, as_of: str, periods: tuple[int, ...], name: str) -> DataFrame:
        """period_days, subject, ``name``: merged over the days of each period that ends with ``as_of``."""
        parts = _in_periods(self.distincts.where(F.col("what") == what), as_of, periods)
        return merged_distincts(parts, ["period_days", "subject"], name)

    def address_counts(self, which: str, as_of: str, periods: tuple[int, ...], name: str, **totals) -> DataFrame:
        """period_days, source_ip, ``name``: the users of ``which`` pairs, and their totals, in one pass."""
        cells = member_rows(_in_periods(self.pairs.where(which), as_of, periods), "user_id")
        return merged_distincts(cells, ["period_days", "source_ip"], name, **totals)


def _from_day(since: str | None) -> Column:
    if since is None:
        return F.lit(True)
    return F.col("event_date") >= F.lit(date.fromisoformat(since))


def _in_periods(parts: DataFrame, as_of: str, periods: tuple[int, ...]) -> DataFrame:
    """The parts of each period: the ``period_days`` days up to and with ``as_of``."""
    last = F.lit(date.fromisoformat(as_of))
    near = parts.where((F.col("event_date") <= last) & (F.col("event_date") > F.date_sub(last, max(periods))))
    return near.withColumn("period_days", F.explode(F.array(*map(F.lit, sorted(periods))))).where(
        F.date_diff(last, F.col("event_date")) < F.col("period_days")
    )


# --- reports ------------------------------------------------------------------------------


def kpi_of(rollups: Rollups, since: str | None) -> DataFrame:
    """→ total_events, failed_logins, successful_logins, external_ips."""
    per_address = rollups.pairs.where(_from_day(since)).groupBy("source_ip", "is_external").agg(
        F.sum("events").alias("events"), F.sum("failures").alias("failures")
    )
    return per_address.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
        F.coalesce(F.sum("failures"), F.lit(0)).alias("failed_logins"),
        F.coalesce(F.sum(F.col("events") - F.col("failures")), F.lit(0)).alias("successful_logins"),
        F.count_if("is_external").alias("external_ips"),
    )


def executive_of(wh: Warehouse, rollups: Rollups, since: str | None) -> DataFrame:
    """The executive report; of ``wh`` only the dimensions are read."""
    return executive_dashboard(wh, since, *side_by_side(
        lambda: computed_once(rollups.pair_rollup(since)),
        lambda: computed_once(rollups.failures_by_host_and_day(since)),
    ))


def scenarios_of(wh: Warehouse, rollups: Rollups, since: str | None) -> DataFrame:
    """Events per scenario."""
    return scenario_classification(wh, since, rollup=computed_once(rollups.pair_rollup(since)))


def document_of(wh: Warehouse, rollups: Rollups, generated_at: str, since: str | None) -> DataFrame:
    """The dashboard document's lines; of ``wh`` only the dimensions are read."""
    return dashboard_document(
        wh, generated_at, since, rollup=computed_once(rollups.pair_rollup(since)),
        host_cells=rollups.failures_by_host_and_address(since).withColumnRenamed("host_id", "dest_host_id"),
    )


def spraying_over_periods(rollups: Rollups, as_of: str, periods: tuple[int, ...] = PERIODS,
                          threshold: int = 5) -> DataFrame:
    """→ period_days, source_ip, users_targeted, total_attempts, attack_start, attack_end."""
    return (
        rollups.address_counts(
            "failures > 0", as_of, periods, "users_targeted", total_attempts=(F.sum, "failures"),
            attack_start=(F.min, "first_failure"), attack_end=(F.max, "last_failure"),
        )
        .where((F.col("users_targeted") >= threshold) & F.col("source_ip").isNotNull())
        .orderBy("period_days", F.desc("users_targeted"), "source_ip")
    )


def external_over_periods(rollups: Rollups, as_of: str, periods: tuple[int, ...] = PERIODS) -> DataFrame:
    """→ period_days, source_ip, outcomes, unique_users_targeted, unique_hosts_targeted, first and last seen."""
    keys = ["period_days", "source_ip"]
    users, hosts = "unique_users_targeted", "unique_hosts_targeted"
    totals = rollups.address_counts(
        "is_external", as_of, periods, users, total_attempts=(F.sum, "events"), failed_attempts=(F.sum, "failures"),
        first_seen=(F.min, "first_seen"), last_seen=(F.max, "last_seen"),
    )
    reached = rollups.distinct_counts(TARGET_HOSTS, as_of, periods, hosts).withColumnRenamed("subject", "source_ip")
    return totals.join(reached, keys, "left").select(
        *keys, "total_attempts", "failed_attempts", (F.col("total_attempts") - F.col("failed_attempts")).alias("successful_logins"),
        "first_seen", "last_seen", users, F.coalesce(hosts, F.lit(0)).alias(hosts),
    ).orderBy("period_days", F.desc("successful_logins"), F.desc("total_attempts"), "source_ip")


def business_hours_over_periods(rollups: Rollups, as_of: str, periods: tuple[int, ...] = PERIODS) -> DataFrame:
    """→ period_days, is_business_hours, total_attacks, unique_attackers, unique_targets, success_rate_percent."""
    keys = ["period_days", "is_business_hours"]
    totals = _in_periods(rollups.pairs.where("covered"), as_of, periods).groupBy(
        "period_days", F.col("business").alias("is_business_hours")
    ).agg(F.sum("events").alias("total_attacks"), F.sum(F.col("events") - F.col("failures")).alias("succeeded"))
    for what, name in ((ATTACKERS, "unique_attackers"), (TARGETS, "unique_targets")):
        counted = rollups.distinct_counts(what, as_of, periods, name).select(
            "period_days", F.col("subject").cast("boolean").alias("is_business_hours"), name
        )
        totals = totals.join(counted, keys, "left")
    return totals.select(
        *keys, "total_attacks", "unique_attackers", "unique_targets",
        percent(F.col("succeeded"), F.col("total_attacks")).alias("success_rate_percent"),
    ).orderBy(*keys)
