"""Text building: joined lists and zone-free time labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English names, in calendar order.
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)
DAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def joined_members(value: Column, separator: str = ", ") -> Column:
    """Aggregate: values joined in ascending order; NULL when there are none.

    Only for values of a small fixed domain, such as minutes of a year; callers
    group by the value first. Users and addresses are given as rows instead
    (``functions.members``).
    """
    values = F.array_join(F.sort_array(F.collect_list(value)), separator)
    return F.nullif(values, F.lit(""))


def month_name(timestamp: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTHS)), F.month(timestamp))


def day_name(day_of_week: Column) -> Column:
    """Name of a day number, 0 = Sunday."""
    return F.element_at(F.array(*map(F.lit, DAYS)), day_of_week + 1)


def minute_stamp(timestamp: Column) -> Column:
    """``2025-01-20 14:31``; a cast of a zone-free time needs no session zone."""
    return F.substring(timestamp.cast("string"), 1, 16)


def short_stamp(timestamp: Column) -> Column:
    """``Jan 20 14:31``."""
    text = timestamp.cast("string")
    return F.concat(
        F.substring(month_name(timestamp), 1, 3),
        F.lit(" "),
        F.substring(text, 9, 2),
        F.lit(" "),
        F.substring(text, 12, 5),
    )
