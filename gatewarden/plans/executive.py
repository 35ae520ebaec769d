"""The executive report: one row per metric, one per external address."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.members import with_group_counts
from gatewarden.functions.numbers import percent
from gatewarden.functions.shared import computed_once, side_by_side
from gatewarden.functions.text import minute_stamp
from gatewarden.operators import FLOOR
from gatewarden.operators.scenarios import pair_rollup
from gatewarden.plans import executive_texts as T
from gatewarden.sources.warehouse import Warehouse

# Thresholds of the report.
FAILED_WARNING = 10
EXTERNAL_RED = 3
BRUTE_FAILURES = 3
SPRAY_USERS = 5
TRAINING_FAILURES = 3


def executive_dashboard(wh: Warehouse, since: str | None = FLOOR,
                        rollup: DataFrame | None = None,
                        host_days: DataFrame | None = None) -> DataFrame:
    """→ category, metric, value, details, severity.

    The events are read twice: for the (user, address) rollup, and for recent
    failures per host and day; not at all where both are given. Rows that name several addresses or accounts
    come once per name, with the same metric and value.
    """
    pairs, failures = side_by_side(
        lambda: computed_once(pair_rollup(wh, since)) if rollup is None else rollup,
        lambda: computed_once(_host_days(wh, since)) if host_days is None else host_days,
    )
    counted = side_by_side(
        lambda: _address_rows(pairs),
        lambda: _user_rows(wh, pairs),
        lambda: [_brute_force_rows(wh, pairs)],
        lambda: [_actor_rows(wh, pairs)],
    )
    parts = [*chain(*counted), _host_rows(wh, failures), _peak_day_row(failures)]
    rank = F.array_position(F.array(*map(F.lit, T.CATEGORIES)), F.col("category"))
    return reduce(DataFrame.unionByName, parts).orderBy(
        rank, "category", "metric", "details"
    )


def _line(category: str, metric: str | Column, value: Column, details: str | Column,
          severity: str | Column) -> Column:
    texts = {
        "category": category, "metric": metric, "value": value,
        "details": details, "severity": severity,
    }
    return F.struct(
        *[
            (text if isinstance(text, Column) else F.lit(text)).cast("string").alias(name)
            for name, text in texts.items()
        ]
    )


def _lines(aggregate: DataFrame, *lines: Column) -> DataFrame:
    """The report rows of a one-row aggregate; a row without a subject is left out."""
    return aggregate.select(F.inline(F.array(*lines))).filter(F.col("metric").isNotNull())


def _listed(members: DataFrame, number: int, category: str, metric: str, unit: str,
            severity: str) -> DataFrame:
    """One row per ``member`` text, the number repeated; one without details if there are none."""
    def line(details: Column) -> Column:
        return _line(category, metric, F.lit(f"{number} {unit}"), details, severity)

    if not number:
        return members.sparkSession.range(1).select(F.inline(F.array(line(F.lit(None)))))
    return members.select(F.inline(F.array(line(F.col("member")))))


def _count(number: Column, unit: str) -> Column:
    return F.concat(F.coalesce(number, F.lit(0)).cast("string"), F.lit(f" {unit}"))


def _address_rows(rollup: DataFrame) -> list[DataFrame]:
    """Everything that counts events or addresses."""
    per_address = computed_once(
        rollup.filter(F.col("events") > 0)
        .groupBy("source_ip", "is_external")
        .agg(
            F.sum("events").alias("events"),
            F.sum("failures").alias("failures"),
            F.sum("successes").alias("successes"),
            F.count("*").alias("users"),
            F.count_if(F.col("failures") > 0).alias("failed_users"),
            F.min("first_failure").alias("first_failure"),
            F.max("last_failure").alias("last_failure"),
        )
    )
    external = F.coalesce("is_external", F.lit(False))
    sprays = F.col("failed_users") >= SPRAY_USERS
    spray_text = F.concat(
        F.col("source_ip"), F.lit(" ("), F.col("failed_users").cast("string"), F.lit(" users)")
    )
    totals = per_address.agg(
        F.sum("events").alias("events"),
        F.sum("failures").alias("failures"),
        F.sum("successes").alias("successes"),
        F.min("first_failure").alias("first_failure"),
        F.max("last_failure").alias("last_failure"),
        F.count_if(external).alias("external"),
        F.count_if(external & (F.col("failures") > 0)).alias("to_block"),
        F.min_by(
            F.struct("source_ip", "events", "successes", "users"),
            F.when(external, F.struct(-F.col("successes"), -F.col("events"), "source_ip")),
        ).alias("worst"),
    )
    failures, successes, events = (
        F.coalesce(name, F.lit(0)) for name in ("failures", "successes", "events")
    )
    worst = F.col("worst")
    spraying = computed_once(per_address.filter(sprays).select(spray_text.alias("member")))
    listed = _listed(
        spraying, spraying.count(), T.INCIDENTS, T.SPRAYING_DETECTED, T.ATTACKS, T.RED
    )
    return [listed, _lines(
        totals,
        _line(T.OVERALL, T.TOTAL_EVENTS, _count(events, T.EVENTS), "", ""),
        _line(T.OVERALL, T.FAILED_LOGINS, _count(failures, T.ATTEMPTS),
              F.concat(percent(failures, events).cast("string"), F.lit("%")),
              F.when(failures > FAILED_WARNING, T.WARNING).otherwise(T.OK)),
        _line(T.OVERALL, T.SUCCESSFUL_LOGINS, _count(successes, T.LOGINS),
              F.concat(percent(successes, events).cast("string"), F.lit("%")), T.OK),
        _line(T.OVERALL, T.EXTERNAL_SOURCES, _count(F.col("external"), T.SOURCES),
              T.NOT_INTERNAL,
              F.when(F.col("external") > EXTERNAL_RED, T.RED).otherwise(T.YELLOW)),
        _line(T.TOP_THREATS, F.concat(F.lit(T.MOST_DANGEROUS_IP), worst["source_ip"]),
              F.concat(_count(worst["events"], "attack(s) ("),
                       _count(worst["successes"], "succeeded)")),
              _count(worst["users"], T.USERS_TARGETED), T.RED),
        _line(T.TIMELINE, T.FIRST_ATTACK, minute_stamp(F.col("first_failure")),
              T.MONITORING_SINCE, T.PIN),
        _line(T.TIMELINE, T.LATEST_ATTACK, minute_stamp(F.col("last_failure")),
              T.LAST_FAILED_LOGIN, T.PIN),
        _line(T.RECOMMENDATIONS, T.IPS_TO_BLOCK, _count(F.col("to_block"), T.ADDRESSES),
              T.FAILED_EXTERNAL, T.ORANGE),
    )]


def _user_rows(wh: Warehouse, rollup: DataFrame) -> list[DataFrame]:
    """Everything that counts users; only the named rows need the dimension."""
    per_user = rollup.groupBy("user_id").agg(
        F.sum("events").alias("events"),
        F.sum("failures").alias("failures"),
        F.max(
            (F.col("ever_failed") >= BRUTE_FAILURES) & (F.col("ever_succeeded") > 0)
        ).alias("compromised"),
    )
    named = computed_once(
        per_user.join(
            wh.users.select("user_id", "username", "department", "is_privileged"), "user_id", "left"
        )
    )
    privileged = F.coalesce("is_privileged", F.lit(False))
    admin = privileged & (F.col("events") > 0)
    attacked = F.col("username").isNotNull() & (F.col("failures") > 0)
    totals = named.agg(
        F.min_by(
            F.struct("username", "department", privileged.alias("privileged"), "failures"),
            F.when(attacked, F.struct(-F.col("failures"), "username")),
        ).alias("target"),
        F.count_if("compromised").alias("compromised"),
        F.count_if(F.col("failures") >= TRAINING_FAILURES).alias("to_train"),
    )
    target = F.col("target")
    admins = named.filter(admin).select(F.col("username").alias("member"))
    listed = _listed(
        admins, admins.count(), T.OVERALL, T.PRIVILEGED_ACTIVE, T.ACCOUNTS, T.LOCK
    )
    return [listed, _lines(
        totals,
        _line(T.TOP_THREATS, F.concat(F.lit(T.MOST_ATTACKED_USER), target["username"]),
              _count(target["failures"], T.ATTACKS),
              F.concat(target["department"],
                       F.when(target["privileged"], T.PRIVILEGED_MARK).otherwise("")),
              F.when(target["privileged"], T.RED).otherwise(T.YELLOW)),
        _line(T.RECOMMENDATIONS, T.IMMEDIATE_ACTIONS,
              _count(F.col("compromised"), T.ACTIONS),
              T.RESET_PASSWORDS, T.RED),
        _line(T.RECOMMENDATIONS, T.USERS_TO_TRAIN, _count(F.col("to_train"), T.USERS),
              T.SUSPICIOUS_USERS, T.YELLOW),
    )]


def _brute_force_rows(wh: Warehouse, rollup: DataFrame) -> DataFrame:
    """Users with enough failures and any success from the same address; a row per pair."""
    pairs = computed_once(
        rollup.filter((F.col("failures") >= BRUTE_FAILURES) & (F.col("successes") > 0))
        .join(wh.users.select("user_id", "username"), "user_id")
        .select("user_id", F.concat("username", F.lit(" from "), "source_ip").alias("member"))
    )
    users = pairs.select("user_id").distinct().count()
    return _listed(pairs, users, T.INCIDENTS, T.SUCCESSFUL_BRUTE, T.BRUTES, T.RED)


def _actor_rows(wh: Warehouse, rollup: DataFrame) -> DataFrame:
    """One row per external address and account."""
    cells = computed_once(
        rollup.filter(F.col("is_external") & (F.col("events") > 0))
        .join(wh.users.select("user_id", "username"), "user_id")
        .select("source_ip", "username", "events", "failures", "successes")
    )
    groups = computed_once(
        cells.groupBy("source_ip").agg(
            F.sum("events").alias("events"),
            F.sum("failures").alias("failures"),
            F.sum("successes").alias("successes"),
            F.count("*").alias("users"),
        )
    )
    actors = with_group_counts(
        cells.select("source_ip", "username"), groups, ["source_ip"], "users", "username"
    )
    succeeded = F.col("successes") > 0
    verdict = (
        F.when(succeeded & (F.col("failures") >= BRUTE_FAILURES), T.ACTOR_BRUTE_FORCE)
        .when(F.col("users") >= SPRAY_USERS, T.ACTOR_SPRAYING)
        .when(succeeded, T.ACTOR_LOGIN)
        .otherwise(T.ACTOR_BLOCKED)
    )
    return _lines(
        actors,
        _line(T.ACTORS, F.col("source_ip"), _count(F.col("events"), T.ATTEMPTS),
              F.col("username"), verdict),
    )


def _host_days(wh: Warehouse, since: str | None) -> DataFrame:
    """Recent failures per host, which may be unknown, and day."""
    return (
        wh.events_since(since)
        .filter(~F.col("success"))
        .groupBy(
            F.col("dest_host_id").alias("host_id"), F.to_date("event_timestamp").alias("day")
        )
        .agg(F.count("*").alias("failures"))
    )


def _host_rows(wh: Warehouse, host_days: DataFrame) -> DataFrame:
    """Failures per known host."""
    per_host = (
        host_days.filter(F.col("host_id").isNotNull())
        .groupBy("host_id")
        .agg(F.sum("failures").alias("failures"))
        .join(wh.hosts, "host_id")
    )
    critical = F.coalesce(F.col("asset_criticality") == "CRITICAL", F.lit(False))
    totals = per_host.agg(
        F.sum(F.when(critical, F.col("failures"))).alias("critical_failures"),
        F.count_if(critical).alias("critical_hosts"),
        F.min_by(
            F.struct("hostname", "asset_criticality", "failures"),
            F.struct(-F.col("failures"), "hostname"),
        ).alias("target"),
    )
    target = F.col("target")
    level = target["asset_criticality"]
    return _lines(
        totals,
        _line(T.INCIDENTS, T.CRITICAL_ATTACKS,
              _count(F.col("critical_failures"), T.ATTACKS),
              _count(F.col("critical_hosts"), T.SERVERS_TARGETED), T.RED),
        _line(T.TOP_THREATS, F.concat(F.lit(T.MOST_ATTACKED_SERVER), target["hostname"]),
              _count(target["failures"], T.ATTACKS),
              F.concat(level, F.lit(T.CRITICALITY_MARK)),
              F.when(level == "CRITICAL", T.RED).when(level == "HIGH", T.ORANGE)
              .otherwise(T.YELLOW)),
    )


def _peak_day_row(host_days: DataFrame) -> DataFrame:
    """The day with the most failures, the earliest on a tie."""
    per_day = (
        host_days.groupBy("day")
        .agg(F.sum("failures").alias("failures"))
        .orderBy(F.desc("failures"), "day")
        .limit(1)
    )
    return _lines(
        per_day,
        _line(T.TIMELINE, T.PEAK_DAY, F.col("day").cast("string"),
              _count(F.col("failures"), T.ATTACKS), T.CHART),
    )
