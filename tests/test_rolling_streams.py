"""Streams whose state is ordered by time: trailing hours, logins after failures, sessions."""

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gatewarden.operators import rolling_attacks
from gatewarden.session import STREAMING
from gatewarden.streaming.loading import event_stream
from gatewarden.streaming.rolling import compromise_alerts, rolling_spraying_alerts, session_stream
from tests.sample_star import event, frame_of_events, star, tuples

START = datetime(2025, 1, 20)
FAR = event(10**6, 999, 999, "10.9.9.9", "S", "2025-03-01 00:00:00")
FARTHER = event(10**6 + 1, 999, 999, "10.9.9.9", "F", "2025-04-01 00:00:00")
FARTHEST = event(10**6 + 2, 999, 999, "10.9.9.9", "S", "2025-05-01 00:00:00")
AFTER = datetime(2025, 2, 15)


@pytest.fixture(autouse=True)
def rocksdb(spark):
    for key, value in STREAMING.items():
        spark.conf.set(key, value)
    yield
    for key in STREAMING:
        spark.conf.unset(key)


def run(spark, tmp_path, make, batches, name):
    """The rows of the stream over the batches, one file each, and its last progress."""
    landing = tmp_path / f"in-{name}"
    frame_of_events(spark, []).write.mode("append").parquet(str(landing))
    frame = make(event_stream(spark, str(landing)))
    query = (
        frame.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(tmp_path / f"checkpoint-{name}")).start()
    )
    try:
        for rows in batches:
            frame_of_events(spark, rows).coalesce(1).write.mode("append").parquet(str(landing))
            query.processAllAvailable()
        progress = json.loads(query.lastProgress.json)
    finally:
        query.stop()
    return spark.table(name), progress


def closed(batches):
    """The batches and what lets every watermark pass."""
    return [*batches, [FAR, FARTHER], [FARTHEST]]


def at(second):
    return START + timedelta(seconds=second)


def stamped(n, user, host, address, kind, second):
    return event(n, user, host, address, kind, at(second).isoformat(sep=" "))


# --- spraying -----------------------------------------------------------------------------


def crossings(failures, period, threshold):
    """(address, second, users) each time the number of users rises to the threshold."""
    out = []
    for address in {a for a, _, _ in failures}:
        own = [(u, s) for a, u, s in failures if a == address]
        before = 0
        for second in sorted({s for _, s in own} | {s + period + 1 for _, s in own}):
            now = len({u for u, s in own if second - period <= s <= second})
            if before < threshold <= now:
                out.append((address, at(second), now))
            before = now
    return sorted(out)


def alerts_of(frame):
    return sorted(r for r in tuples(frame) if r[1] < AFTER)


def test_a_burst_across_the_full_hour_is_one_alert(spark, tmp_path):
    """09:58 to 10:02: no clock hour has five users."""
    rows = [stamped(n, n, 1, "198.51.100.1", "F", 9 * 3600 + 3480 + 48 * n) for n in range(1, 6)]
    repeated = [stamped(50, 2, 1, "198.51.100.1", "F", 9 * 3600 + 3480 + 48 * 2)]
    again = [stamped(60 + n, n, 1, "198.51.100.1", "F", 10 * 3600 + 600 + n) for n in range(1, 6)]
    found, _ = run(spark, tmp_path, rolling_spraying_alerts, closed([rows[:3], rows[3:] + repeated, again]), "burst")
    assert alerts_of(found) == [("198.51.100.1", at(9 * 3600 + 3480 + 240), 5)]


def test_late_rows_count_and_too_late_ones_do_not(spark, tmp_path):
    first = [stamped(n, n, 1, "198.51.100.1", "F", 36_000 + n) for n in (1, 2, 4, 5)]
    ahead = [stamped(20, 9, 1, "198.51.100.2", "F", 36_000 + 1800)]
    late = [stamped(30, 3, 1, "198.51.100.1", "F", 36_000 + 3)]  # half an hour late, within the lateness
    far = [stamped(40, 9, 1, "198.51.100.2", "F", 36_000 + 7 * 3600)]
    lost = [stamped(50 + n, n, 1, "198.51.100.3", "F", 36_000 + n) for n in range(1, 6)]
    batches = closed([first, ahead, late, far, [stamped(45, 9, 1, "198.51.100.2", "F", 36_000 + 8 * 3600)], lost])
    found, _ = run(spark, tmp_path, rolling_spraying_alerts, batches, "late")
    assert alerts_of(found) == [("198.51.100.1", at(36_005), 5)]


def test_spraying_equals_brute_force(spark, tmp_path):
    dice = random.Random(5)
    failures = [(f"198.51.100.{dice.randint(1, 2)}", dice.randint(1, 6), dice.randint(0, 30_000)) for _ in range(260)]
    failures.sort(key=lambda x: x[2] + dice.randint(0, 3000))
    rows = [stamped(n, u, 1, a, "F", s) for n, (a, u, s) in enumerate(failures)]
    batches = closed([rows[i : i + 65] for i in range(0, 260, 65)])
    found, progress = run(
        spark, tmp_path, lambda e: rolling_spraying_alerts(e, 1800, 4), batches, "sprays"
    )
    expected = crossings(failures, 1800, 4)
    assert len(expected) > 3 and alerts_of(found) == expected
    # once the watermark has passed everything, only the closing rows' own state is left
    assert all(s["numRowsTotal"] <= 12 for s in progress["stateOperators"])


# --- logins after failures ----------------------------------------------------------------


@pytest.mark.parametrize("same_address", [False, True])
def test_logins_after_failures(spark, tmp_path, same_address):
    dice = random.Random(8)
    rows = [
        stamped(n, dice.randint(1, 3), 1, f"10.0.0.{dice.randint(1, 2)}", dice.choice("FFS"), dice.randint(0, 20_000))
        for n in range(200)
    ]
    rows.sort(key=lambda r: r[6])
    edge = [stamped(300 + n, 9, 1, "10.0.0.1", "F", 30_000) for n in range(3)]
    edge += [stamped(310, 9, 1, "10.0.0.1", "S", 33_600), stamped(311, 9, 1, "10.0.0.1", "S", 33_601), edge[0]]
    rows += edge
    failures, logins = defaultdict(int), defaultdict(int)
    for _, user, _, address, _, success, when, _ in rows:
        (logins if success else failures)[(user, address if same_address else "", int((when - START).total_seconds()))] += 1
    expected = []
    for (user, address, s), n in logins.items():
        recent = sum(k for (u, a, t), k in failures.items() if (u, a) == (user, address) and s - 3600 <= t < s)
        if recent >= 3:
            expected.append((user, *([address] if same_address else []), at(s), n, recent))
    batches = closed([rows[:100], rows[100:]])
    found, progress = run(
        spark, tmp_path, lambda e: compromise_alerts(e, same_address=same_address), batches, f"entered{int(same_address)}"
    )
    assert len(expected) > 3
    assert sorted(r for r in tuples(found) if r[-3] < AFTER) == sorted(expected)
    assert all(s["numRowsTotal"] <= 12 for s in progress["stateOperators"])


# --- sessions -----------------------------------------------------------------------------


def test_sessions_equal_the_batch_job(spark, tmp_path):
    dice = random.Random(9)
    rows = []
    for n in range(240):
        kind, second = dice.choice("SSO"), dice.randint(0, 400) * 100
        rows.append(stamped(n, dice.randint(1, 4), dice.randint(1, 2), "10.0.0.1", kind, second))
    rows.sort(key=lambda r: (r[6] - START).total_seconds() + dice.randint(0, 3000))
    wh = star(spark, events=rows)
    names = {u[1]: u[0] for u in tuples(wh.users.select("user_id", "username"))}
    hosts = {h[1]: h[0] for h in tuples(wh.hosts.select("host_id", "hostname"))}
    batch = rolling_attacks.session_durations(wh, longest=2000, since=None)
    expected = sorted((names[u], hosts[h], s, d) for u, h, s, d in tuples(batch))
    found, progress = run(
        spark, tmp_path, lambda e: session_stream(e, longest=2000), closed([rows[:80], rows[80:160], rows[160:]]), "sessions"
    )
    assert len(expected) > 10
    assert sorted(r for r in tuples(found) if r[2] < AFTER) == expected
    # logins that never came to an end are forgotten
    assert all(s["numRowsTotal"] <= 12 for s in progress["stateOperators"])
    assert found.where(F.col("duration_seconds") > 2000).count() == 0
