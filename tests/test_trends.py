"""Series with gaps, changes between periods, calendars that change, habits."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest

from gatewarden.operators import trends
from tests.sample_star import event, star, tuples

IP, OTHER = "198.51.100.1", "198.51.100.2"


def on(n, day, address=IP, kind="F", clock="10:00:00", user=1, host=1):
    return event(n, user, host, address, kind, f"{day} {clock}")


def test_slopes_fill_the_gaps(spark):
    days = ["2025-01-10", "2025-02-03", "2025-02-03", "2025-03-31", "2025-04-02", "2025-04-02", "2025-04-05", "2025-10-01"]
    rows = [on(n, d) for n, d in enumerate(days)] + [on(50, "2025-01-09", OTHER), on(51, "2025-01-09", "10.0.0.1")]
    found = {r["period_start"]: r for r in trends.address_trends(star(spark, events=rows)).where(f"source_ip = '{IP}'").collect()}
    first, last = date(2025, 1, 9), date(2025, 10, 1)
    for start, end, before in (
        (date(2025, 1, 1), date(2025, 3, 31), 0), (date(2025, 4, 1), date(2025, 6, 30), 4), (date(2025, 10, 1), date(2025, 12, 31), 0),
    ):
        low, high = max(start, first), min(end, last)
        y = [days.count((low + timedelta(d)).isoformat()) for d in range((high - low).days + 1)]
        row = found[start]
        assert (row["days"], row["attempts"], row["previous_attempts"], row["change"]) == (len(y), sum(y), before, sum(y) - before)
        if len(y) > 1:
            assert row["slope"] == pytest.approx(np.polyfit(range(len(y)), y, 1)[0])
            assert row["trend"] == ("rising" if row["slope"] > 0 else "falling")
        else:
            assert row["slope"] is None and row["trend"] == "steady"
    assert len(found) == 3
    assert trends.address_trends(star(spark, events=[])).count() == 0


def test_changes_between_quarters(spark):
    rows = [on(1, "2024-12-31"), on(2, "2025-01-01"), on(3, "2025-02-01", kind="S"), on(4, "2025-07-01")]
    assert tuples(trends.period_changes(star(spark, events=rows))) == [
        (date(2024, 10, 1), 1, 1, None, None), (date(2025, 1, 1), 2, 1, 1, 0),
        (date(2025, 4, 1), 0, 0, -2, -1), (date(2025, 7, 1), 1, 1, 1, 1),
    ]
    assert trends.period_changes(star(spark, events=[])).count() == 0
    with pytest.raises(ValueError):
        trends.period_changes(star(spark), "day")


def test_a_shift_change_in_mid_year_splits_the_counts(spark):
    shifts = spark.createDataFrame(
        [(date(2025, 1, 1), "DAY", 6), (date(2025, 1, 1), "NIGHT", 22), (date(2025, 7, 1), "EARLY", 4), (date(2025, 7, 1), "LATE", 12)],
        "valid_from date, shift string, starts_hour int",
    )
    holidays = spark.createDataFrame([(date(2025, 7, 4), "b"), (date(2025, 7, 4), "a")], "date date, holiday string")
    rows = [
        on(1, "2024-12-31"), on(2, "2025-06-30", clock="05:59:59"), on(3, "2025-06-30", clock="06:00:00"), on(4, "2025-06-30", clock="22:00:00"),
        on(5, "2025-07-01", clock="03:59:59"), on(6, "2025-07-01", clock="04:00:00"), on(7, "2025-07-04", clock="11:59:59", kind="S"),
    ]
    found = trends.shift_activity_as_of(star(spark, events=rows), shifts, holidays, since=None)
    assert sorted(tuples(found), key=str) == sorted([
        (None, None, 1, 1), ("NIGHT", None, 2, 2), ("DAY", None, 1, 1), ("LATE", None, 1, 1), ("EARLY", None, 1, 1), ("EARLY", "a", 1, 0),
    ], key=str)


def habit_rows():
    rows, n = [], 0
    for day in range(1, 30):
        for hour in (9, 11, 14, 16):
            for user in (1, 2):
                n += 1
                rows.append(on(n, f"2025-01-{day:02d}", "10.0.0.1", "S", f"{hour:02d}:00:00", user, 1))
    for hour in (2, 3):  # the second user comes at night, as never before
        rows.append(on(500 + hour, "2025-01-30", "10.0.0.1", "S", f"{hour:02d}:30:00", 2, 1))
    rows.append(on(510, "2025-01-30", "10.0.0.1", "S", "09:00:00", 1, 1))
    return rows


def test_logins_at_two_in_the_night_are_unusual(spark):
    wh = star(spark, events=habit_rows())
    found = tuples(trends.unusual_days(wh, "2025-01-30"))
    assert found == [("dbaker", "Engineering", 2, 116, 1.0, 2, 0, 0, "unusual_hours")]
    assert tuples(trends.unusual_days(wh, "2025-01-29")) == []


def test_habits_of_loads_add_up(spark, tmp_path):
    """Stored per load and day, they are merged and no event is read."""
    rows = habit_rows() + [on(600 + n, "2025-01-30", f"10.0.0.{n}", "S", "09:00:00", 4, n) for n in range(2, 6)]
    rows += [on(700 + n, "2025-01-20", "10.0.0.1", "S", "09:00:00", 4, 1) for n in range(12)]
    wh = star(spark, events=rows)
    for part in (0, 1):
        trends.habit_days(wh.events.where(f"event_id % 2 = {part}")).write.mode("append").parquet(str(tmp_path / "habits"))
    stored = spark.read.parquet(str(tmp_path / "habits"))
    expected = tuples(trends.unusual_days(wh, "2025-01-30"))
    assert tuples(trends.unusual_days(wh.with_events(wh.events.limit(0)), "2025-01-30", habits=stored)) == expected
    assert [r[-1] for r in expected] == ["unusual_hours", "new_addresses, new_hosts"]
    assert datetime(2025, 1, 30) and expected[1][0] == "kwilson"
