"""The calendar and the temporal jobs."""

from datetime import date, datetime

from pyspark.sql import functions as F

from gatewarden.functions import clock
from gatewarden.functions.clock import Calendar
from gatewarden.operators import temporal
from gatewarden.sources import quality
from gatewarden.sources import warehouse
from tests.sample_star import (
    at, event, frame_of_events, frame_of_hosts, frame_of_users, sample_events, star, tuples,
)


def test_calendar_counts(spark):
    hours = Calendar.of_year(2025).table(spark)
    counts = hours.agg(
        F.count("*"), F.count_if("is_business_hours"), F.count_if("is_night_shift"),
        F.count_if("is_weekend"), F.max("time_id"), F.countDistinct("full_timestamp"),
    )
    assert tuples(counts) == [(8760, 2610, 2920, 2496, 8760, 8760)]
    risks = {r["risk_period"]: r["count"] for r in hours.groupBy("risk_period").count().collect()}
    assert risks == {"HIGH_RISK": 4584, "MEDIUM_RISK": 1566, "NORMAL": 2610}
    span = tuples(temporal.calendar_span(hours))
    assert span == [(8760, datetime(2025, 1, 1), datetime(2025, 12, 31, 23))]


def test_calendar_row(spark):
    row = Calendar.of_year(2025).table(spark).filter("full_timestamp = '2025-01-19 03:00:00'").first()
    assert row.asDict() == {
        "time_id": 436, "full_timestamp": datetime(2025, 1, 19, 3), "date": date(2025, 1, 19),
        "year": 2025, "quarter": 1, "month": 1, "month_name": "January", "week_of_year": 3,
        "day_of_month": 19, "day_of_week": 0, "day_name": "Sunday", "hour": 3, "minute": 0,
        "is_weekend": True, "is_business_hours": False, "is_night_shift": True,
        "risk_period": "HIGH_RISK",
    }


def test_calendar_day(spark):
    rows = tuples(temporal.calendar_day(Calendar.of_year(2025).table(spark)))
    assert len(rows) == 10
    assert rows[8] == (at(20, "08:00:00"), "Monday", 8, False, True, False, "NORMAL")


def test_calendar_ignores_the_session_zone(spark):
    """2025-03-09 02:30 does not exist in New York; zone-free time keeps it."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        hours = Calendar.of_year(2025).table(spark)
        assert hours.count() == hours.select("full_timestamp").distinct().count() == 8760
        gap = hours.filter("full_timestamp = timestamp_ntz'2025-03-09 02:00:00'")
        assert tuples(gap, "hour", "time_id") == [(2, 1611)]
        wh = star(spark, events=[event(1, 1, 1, "10.0.0.1", "F", "2025-03-09 02:30:00")])
        assert tuples(temporal.hourly_attacks(wh), "hour", "attack_count") == [(2, 1)]
        start = wh.events.select(clock.hour_of(F.col("event_timestamp")))
        assert tuples(start) == [(datetime(2025, 3, 9, 2),)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_inline_flags_equal_the_calendar_table(spark):
    """Every hour of two weeks, both ways."""
    rows = [
        event(n, 1, 1, "10.0.0.1", "F", f"2025-02-{1 + n // 24:02d} {n % 24:02d}:17:00")
        for n in range(14 * 24)
    ]
    wh = star(spark, events=rows)
    flags = ["event_id", "day_of_week", "hour", "day_name", "is_weekend", "is_business_hours",
             "is_night_shift", "risk_period"]
    inline = wh.calendar.with_flags(wh.calendar.place(wh.events)).select(*flags)
    joined = temporal.events_by_calendar_join(wh, wh.calendar.table(spark)).select(*flags)
    assert inline.count() == joined.count() == len(rows)
    assert inline.exceptAll(joined).isEmpty()


def test_events_outside_the_calendar_drop_out(spark):
    late = event(99, 1, 1, "10.0.0.1", "F", "2026-01-01 00:00:00")
    wh = star(spark, [late])
    assert tuples(quality.calendar_coverage(wh)) == [(47, 46, 1)]
    assert wh.events.count() == 47
    total = temporal.hourly_attacks(wh).agg(F.sum("attack_count"))
    assert tuples(total) == [(21,)]


def test_attacks_by_hour(sample):
    expected = [
        (3, 9, False, "HIGH_RISK", 42.9),
        (14, 5, True, "NORMAL", 23.8),
        (16, 3, True, "NORMAL", 14.3),
        (22, 2, False, "HIGH_RISK", 9.5),
        (2, 1, False, "HIGH_RISK", 4.8),
        (17, 1, True, "NORMAL", 4.8),
    ]
    assert tuples(temporal.attacks_by_hour(sample)) == expected
    assert tuples(temporal.hourly_attacks(sample)) == sorted(row[:4] for row in expected)


def test_business_hours(sample):
    assert tuples(temporal.business_hours_comparison(sample)) == [
        (True, 23, 10, 9, 60.9), (False, 23, 6, 9, 47.8)
    ]
    assert tuples(temporal.business_hours_dashboard(sample)) == [
        ("Business Hours", 23, 10, 14), ("Off-Hours", 23, 6, 11)
    ]


def test_day_of_week(sample):
    expected = [
        ("Sunday", True, 12, 9, 3), ("Monday", False, 29, 10, 19), ("Saturday", True, 5, 2, 3)
    ]
    assert tuples(temporal.day_of_week_pattern(sample)) == expected
    assert tuples(temporal.day_of_week_dashboard(sample)) == [row[:4] for row in expected]


def test_high_risk_period(sample):
    rows = tuples(temporal.high_risk_period_attacks(sample))
    assert len(rows) == 11
    assert rows[0] == ("10.0.1.50", "kwilson", "HIGH_RISK", 2, "Jan 18 22:15, Jan 18 22:20")
    assert {(r[0], r[1]) for r in rows[1:] if r[1] == "lbrown"} == {
        ("10.50.2.10", "lbrown"), ("45.142.212.61", "lbrown"), ("198.51.100.42", "lbrown")
    }


def test_night_shift(spark, sample):
    assert tuples(temporal.night_shift_anomalies(sample)) == [
        ("jsmith", "Finance", False, 1, at(20, "02:15:00"), at(20, "02:15:00"))
    ]
    users = [(1, "nobody", None, False)]
    wh = star(spark, users=users, events=[event(1, 1, 1, "10.0.0.1", "S", "2025-01-20 03:00:00")])
    assert tuples(temporal.night_shift_anomalies(wh)) == []


def test_heatmap(sample):
    assert tuples(temporal.hourly_heatmap(sample)) == [
        ("Sunday", 3, 9, "CRITICAL"), ("Monday", 2, 1, "MEDIUM"), ("Monday", 14, 5, "CRITICAL"),
        ("Monday", 16, 3, "HIGH"), ("Monday", 17, 1, "MEDIUM"), ("Saturday", 22, 2, "MEDIUM"),
    ]


def test_privileged_off_hours(sample):
    rows = tuples(temporal.privileged_off_hours(sample), "username")
    assert rows == [("svc-backup",)] * 9
    assert temporal.privileged_off_hours_detail(sample).count() == 9


def test_spray_by_hour(sample):
    assert tuples(temporal.spray_by_hour(sample)) == [(3, 9, 8)]


def test_department_nights(sample):
    assert tuples(temporal.department_night_logins(sample), "event_id", "username") == [
        (25, "jsmith")
    ]


def test_hour_boundaries(spark):
    """5–8 and 17–22 on a weekday and a weekend day."""
    hours = (5, 6, 7, 8, 17, 18, 21, 22)
    rows = [
        event(n, 1, 1, "10.0.0.1", "F", f"2025-01-{day} {hour:02d}:59:59")
        for n, (day, hour) in enumerate((d, h) for d in ("18", "20") for h in hours)
    ]
    wh = star(spark, events=rows)
    flagged = wh.calendar.with_flags(wh.calendar.place(wh.events))
    weekday = flagged.filter("not is_weekend").orderBy("hour")
    assert tuples(weekday, "is_business_hours") == [
        (h in (8, 17),) for h in hours
    ]
    assert [r[0] for r in tuples(weekday, "risk_period")] == [
        "HIGH_RISK", "MEDIUM_RISK", "MEDIUM_RISK", "NORMAL", "NORMAL", "MEDIUM_RISK",
        "MEDIUM_RISK", "HIGH_RISK",
    ]
    weekend = flagged.filter("is_weekend")
    assert set(tuples(weekend, "risk_period")) == {("HIGH_RISK",)}


def test_changed_working_hours(spark):
    calendar = Calendar(date(2025, 1, 1), date(2025, 12, 31), business_hours=(9, 16), night_starts=20, night_ends=7)
    wh = star(spark, calendar=calendar)
    rows = tuples(temporal.business_hours_comparison(wh), "is_business_hours", "total_attacks")
    inside = sum(1 for e in sample_events() if e[6].day == 20 and 9 <= e[6].hour <= 16)
    assert rows == [(True, inside), (False, 46 - inside)]


def test_calendar_sized_from_data(spark, sample):
    hours = temporal.calendar_of(sample)
    assert tuples(temporal.calendar_span(hours)) == [
        (72, datetime(2025, 1, 18), datetime(2025, 1, 20, 23))
    ]
    assert temporal.calendar_of(star(spark, events=[])).count() == 0


def test_default_calendar_covers_every_year(spark, tmp_path):
    rows = [*sample_events(), event(100, 1, 1, "10.0.0.1", "F", "2031-03-09 02:30:00")]
    warehouse.store(str(tmp_path), frame_of_users(spark), frame_of_hosts(spark), frame_of_events(spark, rows))
    wh = warehouse.open_warehouse(spark, str(tmp_path))
    assert tuples(quality.calendar_coverage(wh)) == [(47, 47, 0)]
    assert temporal.week_cells(wh, None).agg(F.sum("events")).first()[0] == 47
    hours = temporal.calendar_of(wh)
    first, last = datetime(2025, 1, 18), datetime(2031, 3, 9, 23)
    assert tuples(temporal.calendar_span(hours)) == [((last - first).days * 24 + 24, first, last)]
    far = star(spark, [event(101, 1, 1, "10.0.0.1", "F", "2525-12-31 23:59:59")], calendar=Calendar())
    assert temporal.calendar_of(far).filter("year = 2525").count() == 8760
