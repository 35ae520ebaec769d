"""Trailing sums and next events with bounded partitions and linear work.

A window over one user's whole history would put a hot user into one task.
Here time is cut into spans as long as the window, and every cell also goes to
the neighbouring span that needs it as context. Cells are whole seconds, so one
partition holds at most two spans' worth of seconds, however many events the
key has.

A trailing sum is kept as a running sum of changes: a cell adds its amount when
it occurs and takes it back when it leaves the window. A sliding frame would
add up every frame anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewarden.functions.clock import epoch_second


#: Seconds of a span in which running totals are kept apart.
SPAN = 3600


def second_cells(events: DataFrame, *keys: str | Column, **measures: Column) -> DataFrame:
    """Events collapsed to (keys, ``second``) with the given aggregates."""
    second = epoch_second(F.col("event_timestamp")).alias("second")
    return events.groupBy(*keys, second).agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )


def trailing(cells: DataFrame, keys: list[str], seconds: int, measure: str, name: str,
             inclusive: bool = True) -> DataFrame:
    """Add ``name``: the sum of ``measure`` over the last ``seconds``, up to the cell
    or, if not ``inclusive``, strictly before its second."""
    delay = 0 if inclusive else 1
    home, second, amount = F.floor(F.col("second") / seconds), F.col("second"), F.col(measure)

    def change(span: Column, time: Column, delta: Column, own: bool) -> Column:
        return F.struct(
            span.alias("_span"), time.alias("_time"),
            delta.cast("bigint").alias("_delta"), F.lit(own).alias("_own"),
        )

    changes = [
        change(home, second, amount if inclusive else F.lit(0), True),
        change(home + 1, second + delay, amount, False),
        change(home + 1, second + seconds + 1, -amount, False),
    ]
    if not inclusive:
        changes.append(change(home, second + delay, amount, False))
    window = (
        Window.partitionBy(*keys, "_span")
        .orderBy("_time")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        cells.select("*", F.inline(F.array(*changes)))
        .withColumn(name, F.sum("_delta").over(window))
        .filter("_own")
        .drop("_span", "_time", "_delta", "_own")
    )


def latest_before(cells: DataFrame, keys: list[str], seconds: int, marked: Column, name: str,
                  value: Column | None = None) -> DataFrame:
    """Add ``name``: the latest marked cell of the key in the ``seconds`` before, NULL if there is none.

    It is the cell's ``value``, by default its second; cells of one second do not see each other.
    Every marked cell also goes to the next span, so a partition has at most two spans of seconds.
    """
    home, mine = F.floor(F.col("second") / seconds), F.lit(0)
    mark = F.when(marked, F.struct(F.col("second").alias("at"), (F.col("second") if value is None else value).alias("value")))
    window = (
        Window.partitionBy(*keys, "_span").orderBy("second")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    copies = F.array(
        F.struct(home.alias("_span"), mine.alias("_copy")),
        F.when(marked, F.struct((home + 1).alias("_span"), F.lit(1).alias("_copy"))),
    )
    latest = F.col("_latest")
    return (
        cells.select("*", mark.alias("_mark"), F.inline(F.filter(copies, lambda c: c.isNotNull())))
        .withColumn("_latest", F.max("_mark").over(window))
        .filter("_copy = 0")
        .withColumn(name, F.when(F.col("second") - latest["at"] <= seconds, latest["value"]))
        .drop("_mark", "_span", "_copy", "_latest")
    )


def following(cells: DataFrame, keys: list[str], seconds: int, columns: list[str]) -> DataFrame:
    """Add ``next_<column>`` of the next cell of the key, NULL when later than ``seconds``."""
    window = Window.partitionBy(*keys, "_span").orderBy("second")
    near = F.lead("second").over(window) - F.col("second") <= seconds
    return (
        cells.withColumn("_home", F.floor(F.col("second") / seconds))
        .withColumn("_span", F.explode(F.array(F.col("_home"), F.col("_home") - 1)))
        .withColumns(
            {
                f"next_{name}": F.when(near, F.lead(name).over(window))
                for name in ("second", *columns)
            }
        )
        .filter(F.col("_home") == F.col("_span"))
        .drop("_home", "_span")
    )


def distinct_trailing(cells: DataFrame, keys: list[str], member: str, seconds: int,
                      name: str) -> DataFrame:
    """Per key and second of ``cells``: how many members occurred in the last ``seconds``.

    → keys, ``second``, ``name``; the cell's own second counts. A member counts
    from a cell without another in the period before, until the period after
    its last cell is over; those beginnings and ends are added up along the
    key's time. Work is linear in the cells, however long the period.
    """
    own = cells.select(*keys, member, "second").distinct().withColumn("_hit", F.lit(1))
    linked = following(
        trailing(own, [*keys, member], seconds, "_hit", "_before", inclusive=False),
        [*keys, member], seconds, [],
    )

    def change(time: Column, delta: Column, asked: bool) -> Column:
        return F.struct(
            time.alias("second"), delta.cast("bigint").alias("_delta"), F.lit(asked).alias("_asked")
        )

    changes = linked.select(*keys, F.inline(F.array(
        change(F.col("second"), F.when(F.col("_before") == 0, 1).otherwise(0), True),
        change(F.col("second") + seconds + 1,
               F.when(F.col("next_second").isNull(), -1).otherwise(0), False),
    )))
    steps = (
        changes.groupBy(*keys, "second")
        .agg(F.sum("_delta").alias("_delta"), F.bool_or("_asked").alias("_asked"))
        .withColumn("_span", F.floor(F.col("second") / SPAN))
    )
    return (
        running_total(steps, keys, "_delta", name)
        .filter("_asked")
        .select(*keys, "second", name)
    )


def running_total(steps: DataFrame, keys: list[str], measure: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``measure`` of the key up to the row's second.

    ``steps`` has one row per key and second, and its ``_span``. Sums within a
    span and sums of the spans before are taken apart, so no window holds more
    than the seconds of a span or the spans of a key.
    """
    within = Window.partitionBy(*keys, "_span").orderBy("second").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        steps.groupBy(*keys, "_span")
        .agg(F.sum(measure).alias("_sum"))
        .select(*keys, "_span", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_earlier"))
    )
    return (
        steps.withColumn("_here", F.sum(measure).over(within))
        .join(spans, [*keys, "_span"])
        .withColumn(name, F.col("_earlier") + F.col("_here"))
        .drop("_here", "_earlier", "_span")
    )


def moment(second: Column) -> Column:
    """Zone-free timestamp of a whole second."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    days = F.floor(second / 86400).cast("int")
    rest = (second % 86400).cast("decimal(18,6)")
    return epoch + F.make_dt_interval(days, F.lit(0), F.lit(0), rest)
