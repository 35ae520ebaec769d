"""Attack steps in their order."""

import random
from datetime import datetime, timedelta

from gatewarden.functions.rolling import latest_before
from gatewarden.operators import sequences
from pyspark.sql import functions as F
from tests.sample_star import event, star, tuples

IP = "198.51.100.42"


def spray(first=1, clock="10:00"):
    return [event(first + n, n + 1, 1, IP, "F", f"2025-01-20 {clock}:{n:02d}") for n in range(5)]


def test_a_login_before_the_spraying_is_no_outcome(spark):
    rows = spray() + [
        event(20, 1, 1, IP, "S", "2025-01-20 09:00:00"),  # before
        event(21, 2, 1, IP, "S", "2025-01-20 12:00:00"),  # after: an outcome
        event(22, 9, 1, IP, "S", "2025-01-20 12:00:00"),  # of a user that was not sprayed
        event(23, 3, 1, "10.0.0.1", "S", "2025-01-20 12:00:00"),  # from elsewhere
        event(24, 4, 1, IP, "S", "2025-01-21 10:00:05"),  # more than a day later
        event(25, 5, 1, IP, "S", "2025-01-20 10:00:04"),  # in the last failure's second
    ]
    found = tuples(sequences.spray_entries(star(spark, events=rows)))
    assert found == [(IP, "dbaker", 5, datetime(2025, 1, 20, 10, 0, 4), datetime(2025, 1, 20, 12), 1)]


def test_hosts_reached_after_the_entry(spark):
    rows = spray() + [
        event(21, 2, 1, IP, "S", "2025-01-20 12:00:00"),
        event(30, 2, 2, "10.0.0.1", "S", "2025-01-20 11:59:59"),  # before the entry
        event(31, 2, 2, "10.0.0.1", "S", "2025-01-20 13:00:00"),
        event(32, 2, 2, "10.0.0.1", "S", "2025-01-20 14:00:00"),
        event(33, 2, 3, "10.0.0.1", "S", "2025-01-21 12:00:00"),  # the last second of the day after
        event(34, 2, 4, "10.0.0.1", "S", "2025-01-21 12:00:01"),
        event(35, 3, 4, "10.0.0.1", "S", "2025-01-20 13:00:00"),
    ]
    found = tuples(sequences.spray_movements(star(spark, events=rows)), "username", "source_ip", "hostname", "moved_at", "logins")
    assert found == [
        ("dbaker", IP, "database-prod-01", datetime(2025, 1, 20, 13), 2),
        ("dbaker", IP, "vpn-gateway", datetime(2025, 1, 21, 12), 1),
    ]


def test_latest_before_equals_brute_force(spark):
    dice = random.Random(2)
    cells = sorted({(dice.randint(1, 2), dice.randint(0, 3000)) for _ in range(300)})
    rows = [(k, s, dice.random() < 0.3) for k, s in cells]
    frame = spark.createDataFrame(rows, "k int, second bigint, marked boolean")
    for seconds in (7, 100, 5000):
        found = latest_before(frame, ["k"], seconds, F.col("marked"), "at")
        expected = {
            (k, s): max((t for key, t, m in rows if key == k and m and s - seconds <= t < s), default=None) for k, s, _ in rows
        }
        assert {(r["k"], r["second"]): r["at"] for r in found.collect()} == expected
        assert found.count() == len(rows)


def test_a_hot_address_does_not_grow_its_windows(spark):
    """Every window is cut by spans of the period: the plan has no window over an address alone."""
    base = datetime(2025, 1, 20)
    rows = [
        event(n, n % 6 + 1, 1, IP, "F" if n % 4 else "S", (base + timedelta(minutes=n)).isoformat(sep=" ")) for n in range(600)
    ]
    found = sequences.spray_entries(star(spark, events=rows))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.strip().lstrip(":+- ").startswith("Window")]
    assert windows and all("_span" in line for line in windows)
    assert found.count() == sum(1 for n in range(600) if n % 4 == 0 and n >= 8)
