"""Exact counting expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_when(condition: Column) -> Column:
    """Number of rows where the condition holds; 0, never NULL."""
    return F.count_if(condition)


def percent(part: Column, total: Column) -> Column:
    """``part`` as a percentage of ``total``, one decimal, halves rounded up.

    Integer arithmetic keeps the rounding exact for any count; a zero total
    gives NULL instead of an error.
    """
    doubled = F.nullif(total * 2, F.lit(0))
    tenths = F.call_function("div", part * 2000 + total, doubled)
    return (tenths / F.lit(10.0)).cast("double")
