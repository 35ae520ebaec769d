"""The dashboard document: a summary, record lists, and the JSON around them.

The document is produced as ordered text lines, not as one value: an actor list
may be long, and lines can be written by many tasks. The part files, read in
order, are the JSON document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once
from gatewarden.functions.text import DAYS
from gatewarden.operators import FLOOR
from gatewarden.operators.assets import critical_assets_dashboard
from gatewarden.operators.external import rate_actors
from gatewarden.operators.scenarios import pair_rollup, scenario_classification
from gatewarden.operators.temporal import (
    business_hours_dashboard,
    day_of_week_dashboard,
    hour_cells,
    hourly_attacks,
)
from gatewarden.sources.warehouse import Warehouse

# Sections in document order; the last three are nested.
MAIN_SECTIONS = ("summary", "scenarios", "threat_actors", "critical_assets")
TEMPORAL_SECTIONS = ("hourly_attacks", "business_hours", "day_of_week")
TEMPORAL_KEY = "temporal_analysis"


def dashboard_records(wh: Warehouse, since: str | None = FLOOR, temporal: bool = False,
                      rollup: DataFrame | None = None,
                      host_cells: DataFrame | None = None) -> DataFrame:
    """→ section, section_no, rank (orders a section), record (JSON text).

    The events are read at most three times: for the (user, address) rollup,
    the attacked hosts, and the hours. Actors have one record per account.
    """
    if rollup is None:
        rollup = computed_once(pair_rollup(wh, since))
    frames = {
        "summary": (_summary(rollup), []),
        "scenarios": (
            scenario_classification(wh, since, rollup=rollup),
            [_down(F.col("event_count")), F.col("scenario")],
        ),
        "threat_actors": (
            rate_actors(computed_once(_actor_cells(wh, rollup))),
            [
                _down(F.col("successful")), _down(F.col("total_attempts")), F.col("ip_address"),
                F.col("username"),
            ],
        ),
        "critical_assets": (
            critical_assets_dashboard(wh, since, host_cells),
            [_down(F.col("attack_count")), F.col("hostname")],
        ),
    }
    if temporal:
        day_number = F.array_position(F.array(*map(F.lit, DAYS)), F.col("day_name"))
        # One pass feeds all three sections.
        cells = computed_once(hour_cells(wh, since, "source_ip"))
        frames |= {
            "hourly_attacks": (
                hourly_attacks(wh, since, cells),
                [_up(F.col("hour")), _up(F.col("is_business_hours").cast("int"))],
            ),
            "business_hours": (business_hours_dashboard(wh, since, cells), [F.col("period")]),
            "day_of_week": (day_of_week_dashboard(wh, since, cells), [_up(day_number)]),
        }
    parts = [
        _records(frame, number, section, order)
        for number, (section, (frame, order)) in enumerate(frames.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def _summary(rollup: DataFrame) -> DataFrame:
    """The four headline counts from the rollup."""
    per_address = (
        rollup.filter(F.col("events") > 0)
        .groupBy("source_ip", "is_external")
        .agg(*[F.sum(name).alias(name) for name in ("events", "failures", "successes")])
    )
    return per_address.agg(
        *[
            F.coalesce(F.sum(name), F.lit(0)).alias(label)
            for name, label in (
                ("events", "total_events"),
                ("failures", "failed_logins"),
                ("successes", "successful_logins"),
            )
        ],
        F.count_if("is_external").alias("external_threats"),
    )


def _actor_cells(wh: Warehouse, rollup: DataFrame) -> DataFrame:
    return (
        rollup.filter(F.col("is_external") & (F.col("events") > 0))
        .join(wh.users.select("user_id", "username"), "user_id")
        .select("source_ip", "username", "events", "successes", "failures")
    )


def _records(frame: DataFrame, number: int, section: str, order: list[Column]) -> DataFrame:
    """Rows as JSON text; NULL fields stay in the record."""
    return frame.select(
        F.lit(number).alias("section_no"),
        F.lit(section).alias("section"),
        F.concat_ws("|", *order).alias("rank"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"),
    )


def _up(number: Column) -> Column:
    """Rank text that sorts by the number's value, negatives included."""
    return F.lpad((number.cast("bigint") + F.lit(10**18)).cast("string"), 19, "0")


def _down(number: Column) -> Column:
    return _up(-number)


def dashboard_document(wh: Warehouse, generated_at: str, since: str | None = FLOOR,
                       temporal: bool = False, rollup: DataFrame | None = None,
                       host_cells: DataFrame | None = None) -> DataFrame:
    """→ section_no, place, rank, line; the lines in that order are the JSON document."""
    records = computed_once(dashboard_records(wh, since, temporal, rollup, host_cells))
    first = records.groupBy("section_no").agg(F.min("rank").alias("first_rank"))
    comma = F.when(F.col("rank") == F.col("first_rank"), "").otherwise(",")
    body = records.join(F.broadcast(first), "section_no").select(  # one row per section
        "section_no", F.lit(1).alias("place"), "rank", F.concat(comma, "record").alias("line")
    )
    frame = F.array(
        *[
            F.struct(
                F.lit(number).alias("section_no"),
                F.lit(place).alias("place"),
                F.lit("").alias("rank"),
                F.lit(line).alias("line"),
            )
            for number, place, line in _frame_lines(generated_at, temporal)
        ]
    )
    outline = wh.spark.range(1).select(F.inline(frame))
    return outline.unionByName(body).orderBy("section_no", "place", "rank")


def _frame_lines(generated_at: str, temporal: bool) -> list[tuple[int, int, str]]:
    """Opening (place 0) and closing (place 2) lines around the records."""
    sections = MAIN_SECTIONS + (TEMPORAL_SECTIONS if temporal else ())
    lines = []
    for number, section in enumerate(sections):
        opening = f'"{section}": '
        if number == 0:
            opening = f'{{"generated_at": "{generated_at}", {opening}'
        else:
            opening += "["
        if section == TEMPORAL_SECTIONS[0]:
            opening = f'"{TEMPORAL_KEY}": {{{opening}'
        closing = "" if number == 0 else "]"
        if number < len(sections) - 1:
            closing += ","
        else:
            closing += "}}" if temporal else "}"
        lines += [(number, 0, opening), (number, 2, closing)]
    return lines
