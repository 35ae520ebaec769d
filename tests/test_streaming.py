"""Streams over files of the sample events."""

from pyspark.sql import functions as F

from gatewarden.operators import scenarios
from gatewarden.sources import schemas, warehouse
from gatewarden.sources.warehouse import open_warehouse
from gatewarden.streaming.alerts import brute_force_alerts, spraying_alerts
from gatewarden.streaming.loading import event_stream, load_events
from tests.sample_star import (
    at, event, frame_of_events, frame_of_hosts, frame_of_users, sample_events, tuples,
)

# closes every window of the sample
LAST = event(1000, 1, 1, "10.0.0.1", "F", "2025-02-01 00:00:00")


def landed(spark, path, rows):
    frame_of_events(spark, rows).coalesce(1).write.mode("append").parquet(str(path))


def drain(frame, name, path):
    query = (
        frame.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(path / f"checkpoint-{name}")).start()
    )
    query.processAllAvailable()
    query.stop()
    return frame.sparkSession.table(name)


def test_brute_force_alerts(spark, tmp_path):
    landed(spark, tmp_path / "in", [*sample_events(), LAST])
    found = drain(
        brute_force_alerts(event_stream(spark, str(tmp_path / "in"))), "brute", tmp_path
    )
    rows = tuples(found.orderBy("window_start"), "window_start", "user_id", "source_ip",
                  "failed_attempts", "last_attempt")
    assert rows == [
        (at(20, "14:00:00"), 9, "185.220.101.47", 4, at(20, "14:30:45")),
        (at(20, "16:00:00"), 2, "10.0.3.78", 3, at(20, "16:32:00")),
    ]


def test_sliding_windows_catch_attacks_over_the_hour(spark, tmp_path):
    rows = [
        event(n, 1, 1, "10.0.0.9", "F", f"2025-01-20 {clock}")
        for n, clock in enumerate(("09:40:00", "09:50:00", "10:10:00"))
    ]
    landed(spark, tmp_path / "in", [*rows, LAST])
    stream = event_stream(spark, str(tmp_path / "in"))
    assert drain(brute_force_alerts(stream), "fixed", tmp_path).count() == 0
    sliding = drain(brute_force_alerts(stream, slide="30 minutes"), "sliding", tmp_path)
    assert tuples(sliding, "window_start") == [(at(20, "09:30:00"),)]


def test_spraying_alerts(spark, tmp_path):
    repeated = event(999, 1, 1, "198.51.100.42", "F", "2025-01-19 03:50:00")
    landed(spark, tmp_path / "in", [*sample_events(), repeated, LAST])
    found = drain(
        spraying_alerts(event_stream(spark, str(tmp_path / "in"))), "spray", tmp_path
    )
    assert tuples(found) == [
        (at(19, "03:00:00"), at(19, "04:00:00"), "198.51.100.42", 8, 9)
    ]


def test_batch_and_stream_loads_share_a_table(spark, tmp_path):
    path, rows = str(tmp_path / "wh"), sample_events()
    frame = frame_of_events(spark, rows)

    def part(first, last):
        return warehouse.with_event_defaults(frame.filter(F.col("event_id").between(first, last)))

    def stream(folder="checkpoint"):
        load_events(
            event_stream(spark, str(tmp_path / "in")), path, str(tmp_path / folder), available_now=True
        ).awaitTermination()

    def ids():
        return sorted(r["event_id"] for r in open_warehouse(spark, path).events.collect())

    warehouse.store(path, frame_of_users(spark), frame_of_hosts(spark), frame.filter("event_id <= 20"))
    landed(spark, tmp_path / "in", rows[20:30])
    stream()
    assert ids() == list(range(1, 31))
    warehouse.write_events(part(31, 46), path)
    assert ids() == list(range(1, 47))
    stream()  # a restart without new files
    assert ids() == list(range(1, 47))
    # the batch runs again: its commit is gone, its offsets are there
    (tmp_path / "checkpoint" / "commits" / "0").unlink()
    for left in (tmp_path / "checkpoint" / "commits").glob(".0*"):
        left.unlink()
    stream()
    assert ids() == list(range(1, 47))
    assert open_warehouse(spark, path).events.columns[-1] == "event_date"


def test_a_table_may_begin_with_a_stream(spark, tmp_path):
    path, rows = str(tmp_path / "wh"), sample_events()
    warehouse.with_user_defaults(frame_of_users(spark)).write.parquet(f"{path}/dim_users")
    warehouse.with_host_defaults(frame_of_hosts(spark)).write.parquet(f"{path}/dim_hosts")
    landed(spark, tmp_path / "in", rows[:10])
    load_events(
        event_stream(spark, str(tmp_path / "in")), path, str(tmp_path / "c"), available_now=True
    ).awaitTermination()
    warehouse.write_events(warehouse.with_event_defaults(frame_of_events(spark, rows[10:])), path)
    assert open_warehouse(spark, path).events.count() == 46


def test_continuous_loading(spark, sample, tmp_path):
    warehouse.store(
        str(tmp_path / "wh"), frame_of_users(spark), frame_of_hosts(spark),
        spark.createDataFrame([], schemas.EVENTS),
    )
    rows = sample_events()
    for batch in (rows[:20], rows[20:]):
        landed(spark, tmp_path / "in", batch)
        load_events(
            event_stream(spark, str(tmp_path / "in")), str(tmp_path / "wh"),
            str(tmp_path / "checkpoint"), available_now=True,
        ).awaitTermination()
    loaded = open_warehouse(spark, str(tmp_path / "wh"))
    assert tuples(scenarios.scenario_classification(loaded)) == tuples(
        scenarios.scenario_classification(sample)
    )
