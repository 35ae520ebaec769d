"""Result sinks: JSON Lines, one JSON array, CSV, and the dashboard document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once

# Types JSON has no notation for are written as text.
_NATIVE = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double")


def _plain(frame: DataFrame) -> list[Column]:
    return [
        F.col(name) if kind in _NATIVE else F.col(name).cast("string").alias(name)
        for name, kind in frame.dtypes
    ]


def write_json_lines(frame: DataFrame, path: str) -> None:
    """One object per line, written by all tasks; NULL fields are kept."""
    frame.select(*_plain(frame)).write.mode("overwrite").option(
        "ignoreNullFields", "false"
    ).json(path)


def json_array_lines(frame: DataFrame, *order: str, keep_order: bool = True) -> DataFrame:
    """Lines that, in row order, form one JSON array of row objects.

    ``order`` must identify a row; its columns stay out of the objects unless
    ``keep_order``. The rows are computed once. Each object after the first
    carries its own comma, so no task needs to see another's rows.
    """
    shown = frame if keep_order else frame.drop(*order)
    record = F.to_json(F.struct(*_plain(shown)), {"ignoreNullFields": "false"})
    rows = computed_once(frame.select(F.struct(*order).alias("key"), record.alias("record")))
    first = rows.agg(F.min("key").alias("first_key"))
    body = rows.join(F.broadcast(first), rows["key"] == first["first_key"], "left").select(
        F.lit(1).alias("place"),
        "key",
        F.concat(F.when(F.col("first_key").isNull(), ",").otherwise(""), "record").alias("line"),
    )
    edges = frame.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(place).alias("place"), F.lit(mark).alias("line"))
                    for place, mark in ((0, "["), (2, "]"))
                ]
            )
        )
    )
    return (
        body.unionByName(edges, allowMissingColumns=True).orderBy("place", "key").select("line")
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """Text parts whose file order is the line order."""
    lines.select("line").write.mode("overwrite").text(path)


def write_csv(frame: DataFrame, path: str) -> bool:
    """CSV with a header; nothing is written for an empty result (returns False)."""
    numbered, row = _numbered(frame)
    rows = computed_once(numbered)
    if rows.isEmpty():
        return False
    rows.orderBy(row).drop(row).write.mode("overwrite").option("header", True).csv(path)
    return True


def write_json_array(frame: DataFrame, path: str) -> None:
    """One JSON array in the result's row order; ``[]`` for an empty result."""
    numbered, row = _numbered(frame)
    write_lines(json_array_lines(numbered, row, keep_order=False), path)


def _numbered(frame: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a column that ascends in their order, and its name."""
    row = "_row"
    while row in frame.columns:
        row = f"_{row}"
    return frame.withColumn(row, F.monotonically_increasing_id()), row


def export(frame: DataFrame, path: str) -> bool:
    """Pick the format from the suffix: ``.json`` gives a JSON array, anything else CSV."""
    if path.endswith(".json"):
        write_json_array(frame, path)
        return True
    return write_csv(frame, path)
