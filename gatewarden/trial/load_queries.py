"""Registered queries over loads, periods and side tables: rejects, rollups, ordered steps, zones, trends.

The side tables (networks, shifts, holidays) are derived from the hosts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache, partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once, results_folder, side_by_side
from gatewarden.functions.addresses import with_address_columns
from gatewarden.operators import network_zones, sequences, trends
from gatewarden.plans import rollups
from gatewarden.sources import intake
from gatewarden.sources.warehouse import Warehouse

FLOOR = "2024-01-08"
LAST_DAY = "2024-01-30"
GENERATED_AT = "2024-01-31T00:00:00"
LOADS = 3
DAYS = 86400


def incoming(wh: Warehouse) -> DataFrame:
    """The odd events as a load in which some rows break rules; the even ones are stored already."""
    n = F.col("event_id")

    def broken(column: str, *cases) -> F.Column:
        out = F
        for every, rest, value in cases:
            out = out.when(n % every == rest, value)
        return out.otherwise(F.col(column)).alias(column)

    return wh.events.where(n % 2 == 1).select(
        broken("event_id", (100, 1, F.lit(None)), (14, 1, n + 1), (22, 3, n - 2)),
        broken("user_id", (26, 5, -F.col("user_id")), (58, 9, F.lit(None))),
        broken("dest_host_id", (34, 7, F.lit(999_999_999))),
        broken("source_ip", (38, 9, F.lit("300.1.1.1")), (62, 11, F.lit(None)), (74, 13, F.lit("2001:db8::1"))),
        "event_type",
        broken("success", (46, 11, F.lit(None))),
        broken("event_timestamp", (82, 15, F.lit(None))),
    )


def judged(wh: Warehouse) -> DataFrame:
    stored = computed_once(intake.key_bitmaps(wh.events.where(F.col("event_id") % 2 == 0)))
    return intake.judged_events(incoming(wh), wh.users, wh.hosts, stored)


def rejects(wh: Warehouse) -> DataFrame:
    return judged(wh).where(F.size("reasons") > 0).select(
        "event_id", "user_id", "dest_host_id", "source_ip", F.array_join("reasons", "; ").alias("reasons")
    )


def outcomes(wh: Warehouse) -> DataFrame:
    """Rows per reason; a row counts for each of its reasons, a clean one as accepted."""
    reasons = F.when(F.size("reasons") == 0, F.array(F.lit("accepted"))).otherwise(F.col("reasons"))
    return judged(wh).select(F.explode(reasons).alias("outcome")).groupBy("outcome").agg(F.count("*").alias("rows"))


@lru_cache(maxsize=2)
def after_loads(wh: Warehouse) -> rollups.Rollups:
    """Rollups that three loads wrote, the second of them twice; stored once for all queries of a star.

    The events are split into their loads and stored in one pass, as facts are; each load rolls up its own, next
    to the others. The one that runs again does so after them.
    """
    path = f"{results_folder(wh.spark)}/{uuid.uuid4().hex}"
    split = wh.events.drop("event_type").withColumn("load", F.pmod("event_id", F.lit(LOADS)).cast("int")).drop("event_id")
    split.write.partitionBy("load").parquet(f"{path}/facts")
    facts = wh.spark.read.schema(split.schema).parquet(f"{path}/facts")

    def write(load: int) -> None:
        rollups.write_rollups(facts.where(F.col("load") == load), path, f"load-{load}", wh.calendar)

    side_by_side(*[partial(write, load) for load in range(LOADS)])
    write(1)
    return rollups.Rollups.open(wh.spark, path)


def both_families(wh: Warehouse) -> Warehouse:
    """Every seventh event from an IPv6 address."""
    six = F.concat(
        F.lit("2001:db8:"), F.lower(F.hex(F.col("user_id") % 40)), F.lit("::"), F.lower(F.hex(F.col("event_id") % 5))
    )
    text = F.when(F.col("event_id") % 7 == 0, six).otherwise(F.col("source_ip"))
    return wh.with_events(with_address_columns(wh.events.drop("source_ip_num", "is_external").withColumn("source_ip", text)))


def networks(wh: Warehouse) -> DataFrame:
    """Nested and repeated networks of both families; some are written with bits behind their length."""
    h = F.col("host_id")

    def network(zone: str, internal: F.Column, *parts) -> F.Column:
        return F.struct(
            F.concat(*[p.cast("string") if isinstance(p, F.Column) else F.lit(p) for p in parts]).alias("network"),
            F.col(zone).alias("zone"), internal.alias("is_internal"),
        )

    return wh.hosts.select(F.inline(F.array(
        network("hostname", h % 2 == 0, "10.", h % 3, ".0.", h % 250, "/", 24 + h % 9),
        network("asset_criticality", F.lit(True), "10.", h % 3, ".0.0/16"),
        network("location", F.lit(False), "198.51.", h % 5, ".0/24"),
        network("location", F.lit(True), "2001:db8:", F.lower(F.hex(h % 40)), "::/", 44 + h % 5),
    )))


def shifts(wh: Warehouse) -> DataFrame:
    """Four versions, six days apart, with other hours."""
    h = F.col("host_id").cast("int")
    rows = F.array(*[
        F.struct(F.lit(name).alias("shift"), hour.alias("starts_hour"))
        for name, hour in (("DAY", 6 + h % 3), ("EVENING", F.lit(14)), ("NIGHT", F.lit(22)))
    ])
    return wh.hosts.where(h <= 4).select(F.date_add(F.lit("2024-01-01").cast("date"), h * 6).alias("valid_from"), F.inline(rows))


def holidays(wh: Warehouse) -> DataFrame:
    return wh.hosts.where("asset_criticality = 'CRITICAL'").select(
        F.date_add(F.lit("2024-01-08").cast("date"), (F.col("host_id") % 17).cast("int")).alias("date"),
        F.col("location").alias("holiday"),
    )


JOBS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "rejected_events": rejects,
    "intake_outcomes": outcomes,
    "executive_dashboard_after_loads": lambda wh: rollups.executive_of(wh, after_loads(wh), FLOOR),
    "scenario_classification_after_loads": lambda wh: rollups.scenarios_of(wh, after_loads(wh), FLOOR),
    "kpi_summary_after_loads": lambda wh: rollups.kpi_of(after_loads(wh), FLOOR),
    "soc_dashboard_document_after_loads": lambda wh: rollups.document_of(wh, after_loads(wh), GENERATED_AT, FLOOR),
    "spraying_over_periods": lambda wh: rollups.spraying_over_periods(after_loads(wh), LAST_DAY),
    "external_over_periods": lambda wh: rollups.external_over_periods(after_loads(wh), LAST_DAY),
    "business_hours_over_periods": lambda wh: rollups.business_hours_over_periods(after_loads(wh), LAST_DAY),
    "spray_entries": lambda wh: sequences.spray_entries(wh, 3, 3 * DAYS, 3 * DAYS, FLOOR),
    "spray_movements": lambda wh: sequences.spray_movements(wh, 3, 3 * DAYS, 3 * DAYS, FLOOR),
    "zone_activity": lambda wh: network_zones.zone_activity(both_families(wh), networks(wh), FLOOR),
    "address_trends": lambda wh: trends.address_trends(wh, "week", FLOOR),
    "period_changes": lambda wh: trends.period_changes(wh, "week"),
    "shift_activity_as_of": lambda wh: trends.shift_activity_as_of(wh, shifts(wh), holidays(wh), FLOOR),
    "unusual_days": lambda wh: trends.unusual_days(wh, LAST_DAY, days=20),
}
