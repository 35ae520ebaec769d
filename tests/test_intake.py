"""Rows that break constraints are turned away at load time, in batches and streams."""

import random

import pytest
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once
from gatewarden.sources import intake, warehouse
from gatewarden.streaming.loading import event_stream, load_checked_events
from tests.sample_star import (
    HOSTS, USERS, event, frame_of_events, frame_of_hosts, frame_of_users, sample_events, tuples,
)

BAD = [
    event(1, 1, 1, "10.0.0.1", "F", "2025-02-01 10:00:00"),  # stored before
    event(200, 77, 1, "10.0.0.1", "F", "2025-02-01 10:00:00"),
    event(201, 1, 99, "10.0.0.1", "F", "2025-02-01 10:00:00"),
    event(202, 1, 1, "10.0.0.256", "F", "2025-02-01 10:00:00"),
    event(203, 1, 1, "10.0.0.1", "F", "2025-02-01 10:00:01"),
    event(203, 2, 1, "10.0.0.1", "F", "2025-02-01 10:00:00"),  # earlier: stays
    event(203, 2, 1, "10.0.0.1", "F", "2025-02-01 10:00:02"),
]
GOOD = [
    event(300, 1, None, "2001:db8::1", "S", "2025-02-01 11:00:00"),
    event(301, 2, 1, "10.0.0.1/32", "S", "2025-02-01 11:00:00"),
]
REASONS = [
    (1, ["event_id stored before"]), (200, ["user_id unknown"]), (201, ["dest_host_id unknown"]),
    (202, ["source_ip malformed"]), (203, ["event_id repeated in the load"]), (203, ["event_id repeated in the load"]),
]


@pytest.fixture
def path(spark, tmp_path):
    warehouse.store(str(tmp_path / "wh"), frame_of_users(spark), frame_of_hosts(spark), frame_of_events(spark, []))
    return str(tmp_path / "wh")


def check_in(spark, path, rows, load):
    return intake.check_in(frame_of_events(spark, rows), frame_of_users(spark), frame_of_hosts(spark), path, load)


def stored_ids(spark, path):
    return sorted(r[0] for r in warehouse.open_warehouse(spark, path).events.select("event_id").collect())


def reasons(spark, path):
    return sorted((r.event_id, r.reasons) for r in intake.rejected_events(spark, path).collect())


def test_a_batch_leaves_the_facts_clean(spark, path):
    assert check_in(spark, path, sample_events(), "first") == intake.Outcome(46, 0)
    assert check_in(spark, path, BAD + GOOD, "second") == intake.Outcome(3, 6)
    assert stored_ids(spark, path) == [*range(1, 47), 203, 300, 301]
    assert reasons(spark, path) == REASONS
    kept = warehouse.open_warehouse(spark, path).events.where("event_id = 203").first()
    assert kept["user_id"] == 2


def test_a_load_that_runs_again_changes_nothing(spark, path):
    check_in(spark, path, sample_events(), "first")
    for _ in range(2):
        assert check_in(spark, path, BAD + GOOD, "second") == intake.Outcome(3, 6)
    assert stored_ids(spark, path) == [*range(1, 47), 203, 300, 301]
    assert reasons(spark, path) == REASONS
    intake.compact_keys(spark, path, ["first", "second"], "older")
    assert intake.stored_keys(spark, path).select("load").distinct().collect() == [("older",)]
    assert check_in(spark, path, GOOD, "third") == intake.Outcome(0, 2)


def test_missing_values_and_empty_loads(spark, path):
    assert check_in(spark, path, [], "none") == intake.Outcome(0, 0)
    frame = frame_of_events(spark, [event(1, 1, 1, "10.0.0.1", "F", "2025-02-01 10:00:00")])
    broken = frame.select(*[F.lit(None).cast(t).alias(c) for c, t in frame.dtypes])
    outcome = intake.check_in(broken.union(frame), frame_of_users(spark), frame_of_hosts(spark), path, "nulls")
    assert outcome == intake.Outcome(1, 1)
    assert reasons(spark, path) == [(None, [
        "event_id missing", "user_id missing", "source_ip missing", "success missing", "event_timestamp missing",
    ])]


def test_a_stream_leaves_the_facts_clean(spark, path, tmp_path):
    landing, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")

    def run(rows):
        frame_of_events(spark, rows).coalesce(1).write.mode("append").parquet(str(landing))
        load_checked_events(event_stream(spark, str(landing)), path, checkpoint, available_now=True).awaitTermination()

    run(sample_events())
    run(BAD + GOOD)
    assert stored_ids(spark, path) == [*range(1, 47), 203, 300, 301]
    assert reasons(spark, path) == REASONS


def test_keys_of_any_size_survive_packing(spark):
    dice = random.Random(3)
    edges = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 65536, 2**62, -(2**62)]
    keys = sorted({*edges, *[dice.randint(-200_000, 200_000) for _ in range(3000)]})
    rows = spark.createDataFrame([(k,) for k in keys + [None]], "event_id bigint")
    assert sorted(r[0] for r in intake.unpacked_keys(intake.key_bitmaps(rows)).collect()) == keys


def test_only_hit_ranges_are_unpacked(spark):
    stored = computed_once(intake.key_bitmaps(spark.range(0, 200_000).select(F.col("id").alias("event_id"))))
    rows = spark.createDataFrame([(5,), (150_000,), (400_000,), (5,)], "event_id bigint")
    assert sorted(r[0] for r in intake.repeated_keys(rows, stored).collect()) == [5, 150_000]
    apart = spark.range(0, 200_000, 2).select(F.col("id").alias("event_id"))
    other = computed_once(intake.key_bitmaps(apart))
    odd = spark.createDataFrame([(7,), (199_999,)], "event_id bigint")
    assert intake.repeated_keys(odd, other).count() == 0


def test_a_repeated_key_with_most_rows_is_split(spark, path, monkeypatch):
    """Lookups too long to broadcast take the salted way, and give the same."""
    from gatewarden.functions import skew

    def salted(rows, lookup, keys, weights, row_id, how="inner"):
        return skew.lookup_join(rows, lookup, keys, weights, row_id, how, broadcast_bytes=0, rows_per_task=3)

    monkeypatch.setattr(intake, "lookup_join", salted)
    hot = [event(900, 1, 1, "10.0.0.1", "F", f"2025-02-01 10:00:{n:02d}") for n in range(40)]
    assert check_in(spark, path, hot + BAD[1:] + GOOD, "hot") == intake.Outcome(4, 44)


def test_dimensions_are_judged(spark):
    users = frame_of_users(spark)
    more = users.limit(1).select(F.lit(1).cast("bigint").alias("user_id"), F.lit("zzz").alias("username"), *users.columns[2:])
    taken = users.limit(1).select(F.lit(50).cast("bigint").alias("user_id"), F.lit("admin").alias("username"), *users.columns[2:])
    found = intake.judged_users(users.union(more).union(taken)).where(F.size("reasons") > 0)
    assert tuples(found.orderBy("user_id"), "user_id", "username", "reasons") == [
        (1, "zzz", ["user_id repeated"]), (50, "admin", ["username repeated"]),
    ]
    hosts = frame_of_hosts(spark)
    odd = hosts.limit(1).select(
        F.lit(60).cast("bigint").alias("host_id"), F.lit("new").alias("hostname"), F.lit("URGENT").alias("asset_criticality"),
        *hosts.columns[3:],
    )
    found = intake.judged_hosts(hosts.union(odd)).where(F.size("reasons") > 0)
    assert tuples(found, "host_id", "reasons") == [(60, ["asset_criticality not allowed"])]
    assert intake.judged_hosts(hosts).where(F.size("reasons") > 0).count() == 0
    assert (len(USERS), len(HOSTS)) == (11, 9)
