"""Exact distinct counts that can be merged: over days, loads, or any other parts.

A part keeps, per key and 64 neighbouring members, either its members as rows or, from ``DENSE``
members on, where rows would be longer, one number with a bit for each. Merging unites bits, so a
member of many parts counts once, and no part is ever counted again from its events. Members that
are no numbers are kept as texts. Both ways are one aggregate that combines before it shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: An aggregate that can be taken of its own results: a sum, least or greatest value.
Total = Callable[[str], Column]

#: Members of a range from which one number is shorter than rows.
DENSE = 2

# Fixed value: members of a range, the bits of a bigint.
RANGE = 64

STATE_COLUMNS = ("bucket", "bits", "member", "text")


def _bucket(member: Column) -> Column:
    return F.shiftright(member, 6)


def _bit(member: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), member.bitwiseAND(RANGE - 1).cast("int"))


def distinct_state(cells: DataFrame, keys: list[str], member: str | Column, text: str | Column | None = None,
                   dense: int = DENSE) -> DataFrame:
    """keys, bucket, bits, member, text: the members of each key as mergeable state.

    ``member`` is a bigint; where it is NULL the ``text`` stands for the member. ``cells`` may repeat
    a member.
    """
    number = (F.col(member) if isinstance(member, str) else member).cast("bigint")
    spelt = F.lit(None).cast("string") if text is None else (F.col(text) if isinstance(text, str) else text)
    ranges = (
        cells.select(*keys, number.alias("member"), F.when(number.isNull(), spelt).alias("text"))
        .where(F.col("member").isNotNull() | F.col("text").isNotNull())
        .groupBy(*keys, _bucket(F.col("member")).alias("bucket"), "text")
        .agg(F.bit_or(_bit(F.col("member"))).alias("bits"), F.min("member").alias("least"))
    )
    n, first = F.bit_count("bits"), F.col("bucket") * RANGE
    rows = F.filter(
        F.sequence(first, first + (RANGE - 1)),
        lambda m: F.col("bits").bitwiseAND(_bit(m)) != 0,
    )
    whole = F.array(F.lit(None).cast("bigint"))
    members = (
        F.when(F.col("bits").isNull() | (n >= dense), whole).when(n == 1, F.array("least")).otherwise(rows)
    )
    return ranges.withColumn("member", F.explode(members)).select(
        *keys, "bucket", F.when(F.col("member").isNull(), F.col("bits")).alias("bits"), "member", "text"
    )


def member_rows(cells: DataFrame, member: str) -> DataFrame:
    """Cells that are stored anyway, as state: a row is its own member (none if NULL) and keeps its other columns."""
    return cells.withColumns({
        "member": F.col(member).cast("bigint"), "bucket": _bucket(F.col(member).cast("bigint")),
        "bits": F.lit(None).cast("bigint"), "text": F.lit(None).cast("string"),
    })


def merged_distincts(state: DataFrame, keys: list[str], name: str, **totals: tuple[Total, str]) -> DataFrame:
    """keys, ``name``: how many members a key has over all rows of the state; keys are never NULL.

    A text counts as a range of its own with one bit. ``totals`` are added up in the same pass: a sum,
    least or greatest value of a column of the state.
    """
    bits = F.coalesce("bits", _bit(F.col("member")), F.when(F.col("text").isNotNull(), 1).otherwise(0).cast("bigint"))
    ranges = state.withColumn("bits", bits).groupBy(*keys, "bucket", "text").agg(
        F.bit_count(F.bit_or("bits")).alias("n"), *[total(column).alias(label) for label, (total, column) in totals.items()]
    )
    return ranges.groupBy(*keys).agg(
        F.sum("n").alias(name), *[total(label).alias(label) for label, (total, _) in totals.items()]
    )
