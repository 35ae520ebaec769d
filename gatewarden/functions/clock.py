"""The hourly calendar, as a table and as inline expressions.

One definition serves both: ``Calendar.table`` generates the dimension, and the
temporal jobs evaluate the same flags directly on the event time. Inline flags
need no join, and the calendar's range becomes a plain timestamp filter that
reaches the Parquet scan.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewarden.functions import text

# Risk classes of the hours of a week.
HIGH_RISK = "HIGH_RISK"
MEDIUM_RISK = "MEDIUM_RISK"
NORMAL = "NORMAL"


def naive(value: datetime | date | str) -> Column:
    """Zone-free timestamp literal."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day_of_week(timestamp: Column) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(timestamp) - 1


@dataclass(frozen=True)
class Calendar:
    """Days covered and the working-time rules; hour bounds are inclusive.

    Without days it covers all times; ``spanning`` sizes it from data.
    """

    first_day: date | None = None
    last_day: date | None = None
    business_hours: tuple[int, int] = (8, 17)
    night_starts: int = 22
    night_ends: int = 6
    early_hours: tuple[int, int] = (6, 7)
    late_hours: tuple[int, int] = (18, 21)

    @classmethod
    def of_year(cls, year: int) -> Calendar:
        return cls(date(year, 1, 1), date(year, 12, 31))

    def spanning(self, events: DataFrame) -> Calendar | None:
        """The same rules over the days from the first event to the last; None without events."""
        span = events.agg(
            F.to_date(F.min("event_timestamp")).alias("first"),
            F.to_date(F.max("event_timestamp")).alias("last"),
        ).first()
        if span["first"] is None:
            return None
        return replace(self, first_day=span["first"], last_day=span["last"])

    @property
    def hours(self) -> int:
        return ((self.last_day - self.first_day).days + 1) * 24

    def covers(self, timestamp: Column) -> Column:
        """Whether the calendar has a row for the hour of this time."""
        inside = timestamp.isNotNull()
        if self.first_day is not None:
            inside = inside & (timestamp >= naive(self.first_day))
        if self.last_day is not None:
            inside = inside & (timestamp < naive(self.last_day) + F.make_dt_interval(F.lit(1)))
        return inside

    def is_weekend(self, dow: Column) -> Column:
        return dow.isin(0, 6)

    def is_business_hours(self, dow: Column, hour: Column) -> Column:
        return dow.between(1, 5) & hour.between(*self.business_hours)

    def is_night_shift(self, hour: Column) -> Column:
        return (hour >= self.night_starts) | (hour < self.night_ends)

    def risk_period(self, dow: Column, hour: Column) -> Column:
        return (
            F.when(self.is_weekend(dow) | self.is_night_shift(hour), HIGH_RISK)
            .when(hour.between(*self.early_hours) | hour.between(*self.late_hours), MEDIUM_RISK)
            .otherwise(NORMAL)
        )

    def with_flags(self, frame: DataFrame) -> DataFrame:
        """Add names and flags to rows that have ``day_of_week`` and ``hour``."""
        dow, hour = F.col("day_of_week"), F.col("hour")
        return frame.withColumns(
            {
                "day_name": text.day_name(dow),
                "is_weekend": self.is_weekend(dow),
                "is_business_hours": self.is_business_hours(dow, hour),
                "is_night_shift": self.is_night_shift(hour),
                "risk_period": self.risk_period(dow, hour),
            }
        )

    def place(self, events: DataFrame) -> DataFrame:
        """Events inside the calendar with ``day_of_week`` and ``hour``."""
        when = F.col("event_timestamp")
        return events.filter(self.covers(when)).withColumns(
            {"day_of_week": day_of_week(when), "hour": F.hour(when)}
        )

    def table(self, spark: SparkSession) -> DataFrame:
        """The hour dimension over the calendar's days, which must be known."""
        hours = spark.range(self.hours).select(
            (naive(self.first_day) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias(
                "full_timestamp"
            )
        )
        return self.describe(hours)

    def describe(self, hours: DataFrame) -> DataFrame:
        """All derived columns of hour rows holding ``full_timestamp``."""
        at = F.col("full_timestamp")
        placed = hours.withColumns({"day_of_week": day_of_week(at), "hour": F.hour(at)})
        days = F.unix_date(F.to_date(at)) - F.unix_date(F.lit(self.first_day))
        return self.with_flags(placed).select(
            (days * 24 + F.hour(at) + 1).alias("time_id"),
            at,
            F.to_date(at).alias("date"),
            F.year(at).alias("year"),
            F.quarter(at).alias("quarter"),
            F.month(at).alias("month"),
            text.month_name(at).alias("month_name"),
            F.weekofyear(at).alias("week_of_year"),
            F.dayofmonth(at).alias("day_of_month"),
            "day_of_week",
            "day_name",
            "hour",
            F.lit(0).alias("minute"),
            "is_weekend",
            "is_business_hours",
            "is_night_shift",
            "risk_period",
        )


def epoch_second(timestamp: Column) -> Column:
    """Whole seconds since 1970 of a zone-free time."""
    clock = F.hour(timestamp) * 3600 + F.minute(timestamp) * 60 + F.second(timestamp)
    return F.unix_date(F.to_date(timestamp)).cast("bigint") * 86400 + clock


def hour_of(timestamp: Column) -> Column:
    """Start of the hour, still zone-free (``date_trunc`` would add a zone)."""
    return F.make_timestamp_ntz(
        F.year(timestamp), F.month(timestamp), F.dayofmonth(timestamp),
        F.hour(timestamp), F.lit(0), F.lit(0),
    )
