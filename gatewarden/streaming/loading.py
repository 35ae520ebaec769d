"""Continuous append to the fact table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gatewarden.sources import schemas
from gatewarden.sources.intake import check_in
from gatewarden.sources.warehouse import read_table, replace_load, with_event_defaults


def event_stream(spark: SparkSession, landing: str, source: str = "parquet") -> DataFrame:
    """Files arriving in a landing folder, with the declared schema."""
    reader = spark.readStream.format(source).schema(schemas.EVENTS)
    if source == "csv":
        reader = reader.option("header", True)
    return reader.load(landing)


def load_events(events: DataFrame, warehouse: str, checkpoint: str,
                available_now: bool = False) -> StreamingQuery:
    """Append a stream to the facts of ``warehouse``, exactly once, by day.

    ``checkpoint`` is a folder all executors share; a restarted query goes on
    where it stopped. Every batch replaces the load that carries its number, so
    a batch that runs again adds nothing. The table holds plain files only and
    no sink log, so rows of ``store`` and ``write_events`` stay visible.
    ``available_now`` loads what is there and ends.
    """
    stream = _stream_name(checkpoint)

    def replace_batch(batch: DataFrame, number: int) -> None:
        replace_load(batch, warehouse, f"{stream}-{number}")

    return _started(with_event_defaults(events), replace_batch, checkpoint, available_now)


def load_checked_events(events: DataFrame, warehouse: str, checkpoint: str,
                        available_now: bool = False) -> StreamingQuery:
    """The same, with every batch checked in: rows that break a constraint go to the rejects.

    The dimensions are read anew for each batch, so a user added in between is known. A
    batch that runs again replaces its facts, rejects and keys.
    """
    stream = _stream_name(checkpoint)

    def check_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        users = read_table(spark, f"{warehouse}/dim_users", schemas.USERS)
        hosts = read_table(spark, f"{warehouse}/dim_hosts", schemas.HOSTS)
        check_in(batch, users, hosts, warehouse, f"{stream}-{number}")

    return _started(events, check_batch, checkpoint, available_now)


def _stream_name(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _started(rows: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str,
             available_now: bool) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
