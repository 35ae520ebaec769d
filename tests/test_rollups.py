"""Reports from stored daily rollups, and distinct counts that are merged, not recounted."""

import random
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gatewarden.functions.distincts import distinct_state, member_rows, merged_distincts
from gatewarden.functions.shared import job_results, results_folder
from gatewarden.operators import scenarios
from gatewarden.plans import dashboard, executive, rollups
from gatewarden.sources import warehouse
from gatewarden.trial import load_queries
from tests.sample_star import event, frame_of_events, sample_events, star, tuples
from tests.test_reports import Scans


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """The sample in three loads, the second loaded twice, with an IPv6 and an unreadable address."""
    path = str(tmp_path_factory.mktemp("rollups"))
    rows = sample_events() + [
        event(60, 3, 1, "2001:db8::1", "F", "2025-01-20 10:00:00"), event(61, 3, 2, "2001:db8::1", "S", "2025-01-20 11:00:00"),
        event(62, 4, None, "nowhere", "F", "2025-01-20 11:00:00"),
    ]
    wh = star(spark, events=rows)
    for load in (0, 1, 2, 1):
        part = warehouse.with_event_defaults(frame_of_events(spark, rows)).where(F.col("event_id") % 3 == load)
        rollups.write_rollups(part, path, f"load-{load}", wh.calendar)
    return wh, rollups.Rollups.open(spark, path)


def without_events(wh):
    """A star whose events cannot be read."""
    broken = wh.events.withColumn("event_id", F.raise_error(F.lit("the events were read")).cast("bigint"))
    return wh.with_events(broken.where("event_id > 0"))


@pytest.mark.parametrize("since", [None, "2025-01-20"])
def test_reports_of_rollups_equal_those_of_events(loaded, since):
    wh, stored = loaded
    blind = without_events(wh)
    assert tuples(rollups.executive_of(blind, stored, since)) == tuples(executive.executive_dashboard(wh, since))
    assert tuples(rollups.scenarios_of(blind, stored, since)) == tuples(scenarios.scenario_classification(wh, since))
    assert tuples(rollups.kpi_of(stored, since)) == tuples(scenarios.kpi_summary(wh, since))
    now = "2025-01-31T00:00:00"
    assert tuples(rollups.document_of(blind, stored, now, since)) == tuples(dashboard.dashboard_document(wh, now, since))


def test_floors_are_days(loaded):
    with pytest.raises(ValueError):
        loaded[1].pair_rollup("2025-01-20 10:00:00")


def test_only_the_days_asked_for_are_scanned(loaded):
    parts = rollups.spraying_over_periods(loaded[1], "2025-01-20", (1,), threshold=1)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_periods(loaded):
    _, stored = loaded
    found = tuples(rollups.spraying_over_periods(stored, "2025-01-20", (1, 2), threshold=2))
    assert [(r[0], r[1], r[2], r[3]) for r in found] == [(2, "198.51.100.42", 8, 8)]
    external = {(r[0], r[1]): r for r in tuples(rollups.external_over_periods(stored, "2025-01-20", (1, 3)).select(
        "period_days", "source_ip", "total_attempts", "unique_users_targeted", "unique_hosts_targeted"
    ))}
    assert external[(1, "2001:db8::1")][2:] == (2, 1, 2)
    assert external[(3, "198.51.100.42")][2:] == (8, 8, 4) and (1, "198.51.100.42") not in external
    hours = {r[:2]: r[2:5] for r in tuples(rollups.business_hours_over_periods(stored, "2025-01-20", (3,)))}
    assert hours[(3, True)] == (26, 12, 9)  # the 23, 10 and 9 of the sample and the two more addresses
    assert hours[(3, False)] == (23, 6, 9)


@pytest.mark.parametrize("dense", [1, 3, 512, 10**9])
def test_distincts_merge_exactly(spark, dense):
    """Bitmaps, rows and texts of one key meet in any mixture."""
    dice = random.Random(dense)
    rows = [
        (dice.randint(1, 3), f"k{dice.randint(1, 2)}", dice.choice([dice.randint(-40_000, 40_000), dice.randint(1, 9), None]),
         f"t{dice.randint(1, 4)}")
        for _ in range(600)
    ]
    cells = spark.createDataFrame(rows, "part int, key string, member bigint, text string")
    parts = [distinct_state(cells.where(F.col("part") == p), ["key"], "member", "text", d)
             for p, d in ((1, dense), (2, 2), (3, dense))]
    merged = merged_distincts(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["key"], "n")
    expected = {k: len({(m, None if m is not None else t) for _, key, m, t in rows if key == k}) for k in ("k1", "k2")}
    assert dict(tuples(merged)) == expected


def test_a_load_reads_its_events_twice(spark, tmp_path):
    scans = Scans(star(spark, events=sample_events()))
    rollups.write_rollups(scans.wh.events, str(tmp_path), "load", scans.wh.calendar)
    assert scans.passes == 2


def test_distinct_state_is_one_aggregate(spark):
    """Cells are evaluated once, combined before the only shuffle, and never joined with their counts."""
    cells = spark.range(1000).selectExpr("id % 3 as key", "id as member", "cast(id as string) as text")
    for frame in (distinct_state(cells, ["key"], "member", "text"),
                  merged_distincts(distinct_state(cells, ["key"], "member", "text"), ["key"], "n")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Range (") == 1 and "Join" not in plan and "SortAggregate" not in plan
    assert distinct_state(cells, ["key"], "member", "text")._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_ranges_of_all_signs_keep_every_bit(spark):
    """Lone members are rows, several of 64 neighbours one number, at the ends of bigint too."""
    members = [-(2**63), -(2**63) + 63, -65, -64, -1, 0, 63, 64, 2**63 - 64, 2**63 - 1]
    cells = spark.createDataFrame([("k", m) for m in members], "key string, member bigint")
    for dense in (1, 2, 3):
        state = distinct_state(cells, ["key"], "member", dense=dense)
        assert tuples(merged_distincts(state, ["key"], "n")) == [("k", len(members))]
        kept = {r["member"] for r in state.collect() if r["member"] is not None}
        assert kept == {1: set(), 2: {-65, 64}, 3: set(members)}[dense]


def test_a_load_writes_its_pairs_once(spark, tmp_path):
    """Near-unique pairs are not kept a second time, as an intermediate table or as the users of their addresses."""
    rows = [event(n, n, 1, f"198.51.100.{n % 9}", "F", "2025-01-20 10:00:00") for n in range(1, 900)]
    events = warehouse.with_event_defaults(frame_of_events(spark, rows))
    with job_results(spark) as folder:
        rollups.write_rollups(events, str(tmp_path), "load", star(spark).calendar)
        assert len(list(Path(folder).iterdir())) == 1  # the hosts
    stored = rollups.Rollups.open(spark, str(tmp_path))
    assert stored.pairs.count() == 899 and stored.distincts.count() < 100
    found = rollups.spraying_over_periods(stored, "2025-01-20", (1,))
    assert {r["source_ip"]: r["users_targeted"] for r in found.collect()} == {
        f"198.51.100.{k}": sum(n % 9 == k for n in range(1, 900)) for k in range(9)
    }
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and plan.count("FileScan") == 1


def test_loads_of_one_day_keep_apart(spark, tmp_path):
    """A load takes its state from its own pairs, next to other loads of its days and events without a time."""
    def load(name, *rows):
        events = warehouse.with_event_defaults(frame_of_events(spark, rows))
        rollups.write_rollups(events, str(tmp_path), name, star(spark).calendar)

    day, timeless = "2025-01-20 10:00:00", F.col("event_id") == 4
    load("1", event(1, 1, 1, "198.51.100.1", "F", day), event(2, 2, 1, "198.51.100.1", "S", day))
    load("2", event(3, 3, 2, "198.51.100.2", "F", day))
    rows = frame_of_events(spark, [event(4, 4, 2, "198.51.100.3", "F", day), event(5, 5, 2, "198.51.100.3", "F", day)])
    odd = rows.withColumns({
        "event_timestamp": F.when(~timeless, F.col("event_timestamp")), "user_id": F.when(timeless, F.col("user_id")),
    })
    for _ in range(2):
        rollups.write_rollups(warehouse.with_event_defaults(odd), str(tmp_path), "3", star(spark).calendar)
    rollups.write_rollups(warehouse.with_event_defaults(rows.limit(0)), str(tmp_path), "none", star(spark).calendar)
    state = spark.read.schema("event_date date, load string, what string").parquet(f"{tmp_path}/{rollups.DISTINCTS}")
    assert sorted(tuples(state.where("event_date is not null").groupBy("load", "what").count())) == sorted([
        *[(name, what, 1) for name in "12" for what in (rollups.TARGET_HOSTS, rollups.ATTACKERS, rollups.TARGETS)],
        ("3", rollups.TARGET_HOSTS, 1), ("3", rollups.ATTACKERS, 1),
    ])
    stored = rollups.Rollups.open(spark, str(tmp_path))
    found = rollups.external_over_periods(stored, "2025-01-20", (1,))
    assert sorted(tuples(found.select("source_ip", "total_attempts", "successful_logins", "unique_users_targeted", "unique_hosts_targeted"))) == [
        ("198.51.100.1", 2, 1, 2, 1), ("198.51.100.2", 1, 0, 1, 1), ("198.51.100.3", 1, 0, 0, 1),  # one attempt without a user
    ]


def test_totals_are_added_in_the_pass_of_the_distincts(spark):
    cells = spark.createDataFrame(
        [("k", 1, 5), ("k", 1, 7), ("k", 65, 1), ("k", None, 2), ("l", None, 4), ("l", -(2**63), 6)], "key string, who bigint, amount int"
    )
    merged = merged_distincts(
        member_rows(cells, "who"), ["key"], "n", total=(F.sum, "amount"), least=(F.min, "amount"), most=(F.max, "amount")
    )
    assert sorted(tuples(merged)) == [("k", 2, 15, 1, 7), ("l", 1, 10, 4, 6)]


def test_loads_of_the_trial_read_its_events_once(spark):
    scans = Scans(star(spark, events=sample_events()))
    stored = load_queries.after_loads(scans.wh)
    assert scans.passes == 1
    assert tuples(rollups.kpi_of(stored, None)) == tuples(scenarios.kpi_summary(scans.wh, None))


@pytest.mark.parametrize("per_file, files", [(500_000, 1), (100, 9)])
def test_files_of_a_load_follow_from_its_events(spark, tmp_path, monkeypatch, per_file, files):
    """However small the partitions are that a session asks for, a day has a file per so many events, and every row."""
    monkeypatch.setattr(rollups, "EVENTS_PER_FILE", per_file, raising=False)
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key, None) for key in small}
    rows = [event(n, n, 1, f"198.51.100.{n % 9}", "F", "2025-01-20 10:00:00") for n in range(1, 901)]
    rows.append(event(901, 1, 1, "198.51.100.1", "S", "2025-01-21 10:00:00"))
    events = warehouse.with_event_defaults(frame_of_events(spark, rows))
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        rollups.write_rollups(events, str(tmp_path), "load", star(spark).calendar)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    for day, n in (("2025-01-20", files), ("2025-01-21", 1)):
        assert len(list(tmp_path.glob(f"{rollups.PAIRS}/event_date={day}/load=load/*.parquet"))) == n
        assert 0 < len(list(tmp_path.glob(f"{rollups.DISTINCTS}/event_date={day}/load=load/*.parquet"))) <= n
    stored = rollups.Rollups.open(spark, str(tmp_path))
    assert stored.pairs.count() == 901 and stored.hosts.agg(F.sum("failures")).first()[0] == 900


def test_loads_of_the_trial_run_side_by_side(spark, monkeypatch):
    """The three loads are written at one time, the repeated one after them."""
    together, order, write = threading.Barrier(3), [], rollups.write_rollups

    def waiting(events, path, load, calendar):
        if order.count(load) == 0:
            together.wait(60)
        write(events, path, load, calendar)
        order.append(load)

    monkeypatch.setattr(rollups, "write_rollups", waiting)
    wh = star(spark, events=sample_events())
    with job_results(spark) as folder:
        stored = load_queries.after_loads(wh)
        assert sorted(order[:3]) == ["load-0", "load-1", "load-2"] and order[3:] == ["load-1"]
        assert all(name.startswith(f"file:{folder}") or folder in name for name in stored.pairs.inputFiles())
        assert tuples(rollups.kpi_of(stored, None)) == tuples(scenarios.kpi_summary(wh, None))


def test_parts_of_the_executive_report_run_side_by_side(spark, loaded, monkeypatch):
    """Address, user, brute-force and actor rows are computed at one time, within the job that asked for them."""
    wh, stored = loaded
    expected = tuples(executive.executive_dashboard(wh, None))
    together, folders = threading.Barrier(4), set()

    def waiting(part):
        def run(*given):
            together.wait(60)
            folders.add(results_folder(spark))
            return part(*given)
        return run

    for name in ("_address_rows", "_user_rows", "_brute_force_rows", "_actor_rows"):
        monkeypatch.setattr(executive, name, waiting(getattr(executive, name)))
    with job_results(spark) as folder:
        assert tuples(rollups.executive_of(without_events(wh), stored, None)) == expected
    assert folders == {folder}
