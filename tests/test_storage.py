"""Loading, storing, and result sinks."""

import csv
import json
from datetime import date

from pyspark.sql import functions as F

from gatewarden.operators import brute_force, compromise, scenarios
from gatewarden.plans import dashboard, hunts
from gatewarden.sources import schemas, sinks, warehouse
from tests.sample_star import (
    HOSTS, USERS, event, frame_of_events, frame_of_hosts, frame_of_users, sample_events, star,
    tuples,
)


def stored(spark, path, rows=None):
    warehouse.store(
        str(path), frame_of_users(spark), frame_of_hosts(spark),
        frame_of_events(spark, sample_events() if rows is None else rows),
    )
    return warehouse.open_warehouse(spark, str(path))


def test_store_and_open(spark, sample, tmp_path):
    wh = stored(spark, tmp_path)
    assert (wh.users.count(), wh.hosts.count(), wh.events.count()) == (11, 9, 46)
    assert tuples(brute_force.brute_force(wh)) == tuples(brute_force.brute_force(sample))
    assert tuples(scenarios.kpi_summary(wh)) == [(46, 21, 25, 7)]


def test_reload_and_append(spark, tmp_path):
    stored(spark, tmp_path)
    wh = stored(spark, tmp_path)
    assert wh.events.count() == 46
    more = [event(100, 1, 1, "10.0.0.1", "F", "2025-02-01 10:00:00")]
    warehouse.write_events(
        warehouse.with_event_defaults(frame_of_events(spark, more)), str(tmp_path)
    )
    assert warehouse.open_warehouse(spark, str(tmp_path)).events.count() == 47


def test_partitions_are_pruned(spark, tmp_path):
    wh = stored(spark, tmp_path)
    days = sorted(p.name for p in (tmp_path / "fact_auth_events").glob("event_date=*"))
    assert days == [f"event_date=2025-01-{d}" for d in (18, 19, 20)]
    plan = wh.events_since("2025-01-20")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "event_date" in filters and ">= " in filters
    assert wh.events_since("2025-01-20").count() == sum(e[6].day == 20 for e in sample_events())
    recent = wh.events_within("2025-01-20 12:00:00", hours=10)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_external_flag_reaches_the_scan(spark, tmp_path):
    wh = stored(spark, tmp_path)
    plan = wh.events.filter("is_external")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_external,true)" in plan


def test_a_look_back_prunes_both_scans(spark, tmp_path):
    warehouse.store(
        str(tmp_path), frame_of_users(spark), frame_of_hosts(spark),
        frame_of_events(spark, sample_events()),
    )
    wh = warehouse.open_warehouse(spark, str(tmp_path))
    start = warehouse.lookback_start("2025-01-21 00:00:00", days=1)
    for frame in (
        compromise.pair_history(wh.events_after(start)),
        hunts.hunt_compromises(wh, as_of="2025-01-21 00:00:00", days=1),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        scan = next(x for x in plan.splitlines() if "FileScan" in x and "event_timestamp" in x)
        assert "PartitionFilters: [isnotnull(event_date" in scan and ">= 2025-01-20" in scan
        assert "GreaterThan(event_timestamp,2025-01-20T00:00)" in scan
    assert hunts.hunt_compromises(wh, as_of="2025-01-21 00:00:00", days=1).count() == 2


def test_defaults(spark):
    raw = spark.createDataFrame(
        [(1, 1, None, "10.0.0.1/32", None, True, sample_events()[0][6], None)], schemas.EVENTS
    )
    row = warehouse.with_event_defaults(raw).first()
    assert row["event_type"] == "login"
    assert row["source_ip"] == "10.0.0.1"
    assert row["is_external"] is False
    assert row["event_date"] == date(2025, 1, 19)
    assert row["ingested_at"] is not None
    users = spark.createDataFrame([(1, "a", None, None, None, None)], schemas.USERS)
    user = warehouse.with_user_defaults(users).first()
    assert user["is_privileged"] is False and user["created_at"] is not None
    host = warehouse.with_host_defaults(frame_of_hosts(spark)).first()
    assert host["updated_at"] is not None


def test_csv_and_json_sources(spark, tmp_path):
    frame = frame_of_events(spark, sample_events())
    frame.write.option("header", True).csv(str(tmp_path / "csv"))
    frame.write.json(str(tmp_path / "json"))
    for source in ("csv", "json"):
        back = warehouse.read_table(spark, str(tmp_path / source), schemas.EVENTS, source)
        assert back.exceptAll(frame).isEmpty() and back.count() == 46


def text_of(path) -> str:
    return "\n".join(p.read_text() for p in sorted(path.glob("part-*")) if p.stat().st_size)


def test_json_lines(spark, sample, tmp_path):
    sinks.write_json_lines(brute_force.brute_force(sample), str(tmp_path / "out.json"))
    rows = [json.loads(line) for line in text_of(tmp_path / "out.json").split("\n") if line]
    assert rows[0] == {
        "username": "admin", "department": "IT Security", "is_privileged": True,
        "failed_attempts": 4, "source_ip": "185.220.101.47",
        "first_attempt": "2025-01-20 14:30:00", "last_attempt": "2025-01-20 14:30:45",
    }


def test_exported_json_is_one_array_in_row_order(spark, sample, tmp_path):
    found = brute_force.brute_force(sample, threshold=1)
    assert sinks.export(found, str(tmp_path / "out.json"))
    rows = json.loads(text_of(tmp_path / "out.json"))
    expected = [(r["username"], r["failed_attempts"], r["source_ip"]) for r in found.collect()]
    assert [(r["username"], r["failed_attempts"], r["source_ip"]) for r in rows] == expected
    assert list(rows[0]) == found.columns
    assert sinks.export(found.filter("false"), str(tmp_path / "none.json"))
    assert json.loads(text_of(tmp_path / "none.json")) == []


def test_json_array(spark, sample, tmp_path):
    frame = sample.events.select("event_id", "dest_host_id", "event_timestamp")
    sinks.write_lines(sinks.json_array_lines(frame, "event_id"), str(tmp_path / "array"))
    rows = json.loads(text_of(tmp_path / "array"))
    assert [row["event_id"] for row in rows] == list(range(1, 47))
    assert rows[0]["event_timestamp"] == "2025-01-19 03:45:10"
    nothing = sinks.json_array_lines(frame.filter("false"), "event_id")
    assert json.loads("\n".join(r["line"] for r in nothing.collect())) == []


def test_csv(spark, sample, tmp_path):
    assert sinks.export(brute_force.password_spraying(sample), str(tmp_path / "out.csv"))
    rows = list(csv.DictReader(text_of(tmp_path / "out.csv").splitlines()))
    assert rows[0]["source_ip"] == "198.51.100.42"
    assert [row["targeted_account"] for row in rows[:2]] == ["dbaker", "jsmith"]
    nothing = brute_force.brute_force(sample, threshold=99)
    assert not sinks.write_csv(nothing, str(tmp_path / "none.csv"))
    assert not (tmp_path / "none.csv").exists()


def test_document_parts_form_the_document(spark, sample, tmp_path):
    lines = dashboard.dashboard_document(sample, "now", temporal=True)
    sinks.write_lines(lines, str(tmp_path / "doc"))
    content = json.loads(text_of(tmp_path / "doc"))
    assert content["summary"]["total_events"] == 46
    assert len({row["ip_address"] for row in content["threat_actors"]}) == 7


def test_constants_match_the_sample():
    assert len(USERS) == 11 and len(HOSTS) == 9 and len(sample_events()) == 46


def test_star_takes_address_columns_as_given(spark):
    wh = star(spark)
    again = warehouse.Warehouse.of(wh.users, wh.hosts, wh.events.withColumn(
        "is_external", F.lit(True)))
    assert again.events.filter("is_external").count() == 46


def test_results_of_a_job_end_with_it(spark, sample, tmp_path):
    from pathlib import Path

    from gatewarden.functions import shared

    kept = shared.computed_once(sample.users.select("user_id"))
    with shared.job_results(spark) as folder:
        with shared.job_results(spark) as inner:
            shared.computed_once(sample.users.select("user_id"))
            assert Path(inner).exists() and Path(inner).parent == Path(folder)
        assert not Path(inner).exists()
        brute_force.password_spraying(sample).write.parquet(str(tmp_path / "sprays"))
        assert any(Path(folder).iterdir())
    assert not Path(folder).exists()
    assert spark.read.parquet(str(tmp_path / "sprays")).count() == 8 and kept.count() == 11
    try:
        with shared.job_results(spark) as folder:
            shared.computed_once(sample.users.select("user_id"))
            raise RuntimeError("the job failed")
    except RuntimeError:
        pass
    assert not Path(folder).exists() and shared.results_folder(spark) == str(Path(folder).parent)
