"""Joining many rows to a short lookup, whatever the sizes and the skew.

``lookup_join`` measures the lookup in bytes. A short one is broadcast, and the
rows never move. A longer one is joined by shuffle with the heavy keys split:
their rows get a salt, and the lookup's rows of those keys are repeated per salt.

Every key above the size of a task is split, into as many parts as it needs. At
most ``LISTED_KEYS`` keys can be heavier than ``total / LISTED_KEYS`` rows, so
with that as the least size the list of heavy keys is bounded by arithmetic,
not by a cut. Nothing is dropped: other keys join with the single salt 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a lookup that may be sent to every executor.
BROADCAST_BYTES = 32 << 20
ROWS_PER_TASK = 2_000_000
LISTED_KEYS = 500_000


def data_bytes(frame: DataFrame) -> int:
    """Size of the rows: eight bytes a value, and the bytes of texts."""
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in frame.dtypes if kind == "string"]
    row = sum(texts, F.lit(8 * len(frame.columns)))
    return frame.agg(F.sum(row.cast("bigint")).alias("bytes")).first()["bytes"] or 0


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: list[str],
                weights: Callable[[], DataFrame], row_id: str, how: str = "inner",
                broadcast_bytes: int = BROADCAST_BYTES,
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Join ``rows`` to ``lookup`` (already computed, narrow columns) on ``keys``.

    ``weights`` gives, per key, the number of ``rows`` in a column ``weight``; it
    is only called for a long lookup. ``row_id`` varies within a key.
    """
    if data_bytes(lookup) <= broadcast_bytes:
        return rows.join(F.broadcast(lookup), keys, how)
    return spread_join(rows, lookup, keys, heaviest(weights(), keys, rows_per_task), row_id, how)


def heaviest(weights: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys above ``rows_per_task`` rows with the number of ``splits`` each needs.

    ``weights`` has one row per key. From ``LISTED_KEYS * rows_per_task`` rows
    on, a key counts as heavy from ``total / LISTED_KEYS`` rows.
    """
    total = weights.agg(F.sum("weight").alias("total")).first()["total"] or 0
    least = max(rows_per_task, total // LISTED_KEYS)
    return weights.filter(F.col("weight") > least).select(
        *keys, F.ceil(F.col("weight") / least).cast("int").alias("splits")
    )


def spread_join(rows: DataFrame, lookup: DataFrame, keys: list[str], heavy: DataFrame,
                row_id: str, how: str = "inner") -> DataFrame:
    """Shuffle join with the keys of ``heavy`` spread over their ``splits``."""
    listed = F.broadcast(heavy)  # at most LISTED_KEYS rows, see heaviest
    splits = F.coalesce("splits", F.lit(1))
    salted_rows = (
        rows.join(listed, keys, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(row_id), splits).cast("int"))
        .drop("splits")
    )
    salted_lookup = (
        lookup.join(listed, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), splits - 1)))
        .drop("splits")
    )
    return salted_rows.join(salted_lookup, [*keys, "_salt"], how).drop("_salt")
