"""The star schema: reading, loading with defaults, and storing."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gatewarden.functions.addresses import strip_host_mask, with_address_columns
from gatewarden.functions.clock import Calendar
from gatewarden.sources import schemas


#: The load of events written in batches.
BATCH_LOAD = "batch"


@dataclass(frozen=True)
class Warehouse:
    """The tables every job reads.

    ``events`` carries ``source_ip_num`` and ``is_external`` next to the fact
    columns; a table written by ``store`` also has ``event_date``, its
    partition column.
    """

    users: DataFrame
    hosts: DataFrame
    events: DataFrame
    calendar: Calendar = field(default_factory=Calendar)

    @classmethod
    def of(cls, users: DataFrame, hosts: DataFrame, events: DataFrame,
           calendar: Calendar | None = None) -> Warehouse:
        return cls(users, hosts, with_address_columns(events), calendar or Calendar())

    @property
    def spark(self) -> SparkSession:
        return self.events.sparkSession

    def with_events(self, events: DataFrame) -> Warehouse:
        return replace(self, events=events)

    def looking_back(self, as_of: str | None, *, days: int = 0, hours: int = 0) -> Warehouse:
        """The same star with only the events later than ``as_of`` minus the look-back."""
        return self.with_events(self.events_within(as_of, days=days, hours=hours))

    def events_since(self, floor: str | None) -> DataFrame:
        """Events at or after the floor; prunes date partitions when there are any."""
        if floor is None:
            return self.events
        from_time = F.lit(floor).cast("timestamp_ntz")
        kept = self.events.filter(F.col("event_timestamp") >= from_time)
        if "event_date" in self.events.columns:
            kept = kept.filter(F.col("event_date") >= F.to_date(F.lit(floor)))
        return kept

    def events_within(self, as_of: str | None, *, days: int = 0, hours: int = 0) -> DataFrame:
        """Events later than the start of the look-back; no upper bound."""
        return self.events_after(lookback_start(as_of, days=days, hours=hours))

    def events_after(self, start: str | Column | None) -> DataFrame:
        """Events later than a moment; prunes date partitions when there are any."""
        if start is None:
            return self.events
        start = (start if isinstance(start, Column) else F.lit(start)).cast("timestamp_ntz")
        kept = self.events.filter(F.col("event_timestamp") > start)
        if "event_date" in self.events.columns:
            kept = kept.filter(F.col("event_date") >= F.to_date(start))
        return kept


def lookback_start(as_of: str | None, *, days: int = 0, hours: int = 0) -> Column:
    """``as_of`` (default: now) minus the look-back."""
    moment = F.current_timestamp() if as_of is None else F.lit(as_of)
    return moment.cast("timestamp_ntz") - F.make_dt_interval(F.lit(days), F.lit(hours))


def read_table(spark: SparkSession, path: str, schema: StructType,
               source: str = "parquet") -> DataFrame:
    """Scan with the declared schema (parquet, orc, json or csv with header)."""
    reader = spark.read.format(source).schema(schema)
    if source == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def with_user_defaults(users: DataFrame) -> DataFrame:
    return users.withColumns(
        {
            "is_privileged": F.coalesce("is_privileged", F.lit(False)),
            **_audit(users, "created_at", "updated_at"),
        }
    )


def with_host_defaults(hosts: DataFrame) -> DataFrame:
    return hosts.withColumns(_audit(hosts, "created_at", "updated_at"))


def with_event_defaults(events: DataFrame) -> DataFrame:
    """Fill defaults, clean the address text and add the stored columns."""
    filled = events.withColumns(
        {
            "source_ip": strip_host_mask(F.col("source_ip")),
            "event_type": F.coalesce("event_type", F.lit(schemas.DEFAULT_EVENT_TYPE)),
            **_audit(events, "ingested_at"),
        }
    )
    return with_address_columns(filled).withColumn("event_date", F.to_date("event_timestamp"))


def _audit(frame: DataFrame, *names: str) -> dict:
    now = F.current_timestamp().cast("timestamp_ntz")
    return {
        name: F.coalesce(name, now) if name in frame.columns else now for name in names
    }


def store(path: str, users: DataFrame, hosts: DataFrame, events: DataFrame,
          mode: str = "overwrite") -> None:
    """Write the star as Parquet: ``overwrite`` reloads it, ``append`` adds to it.

    The fact table is partitioned by day and load: ``store`` and ``write_events``
    share one load, a stream has one per batch. The rebalance hint lets Spark split a
    busy day over several writers and merge quiet ones; rows are sorted by user
    and time inside each file so row-group statistics stay narrow.
    """
    with_user_defaults(users).write.mode(mode).parquet(f"{path}/dim_users")
    with_host_defaults(hosts).write.mode(mode).parquet(f"{path}/dim_hosts")
    write_events(with_event_defaults(events), path, mode)


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    _event_writer(events, BATCH_LOAD).mode(mode).parquet(f"{path}/fact_auth_events")


def replace_load(events: DataFrame, path: str, load: str) -> None:
    """Write events as one named load; what that load held before is replaced.

    Only the partitions of this load are touched, so it may run again after a
    failure, next to other loads.
    """
    (
        _event_writer(events, load).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(f"{path}/fact_auth_events")
    )


def _event_writer(events: DataFrame, load: str) -> DataFrameWriter:
    return (
        events.withColumn("load", F.lit(load))
        .hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "user_id", "event_timestamp")
        .write.partitionBy("event_date", "load")
    )


def open_warehouse(spark: SparkSession, path: str, calendar: Calendar | None = None) -> Warehouse:
    """Open a star written by ``store``."""
    return Warehouse.of(
        read_table(spark, f"{path}/dim_users", schemas.USERS),
        read_table(spark, f"{path}/dim_hosts", schemas.HOSTS),
        read_table(spark, f"{path}/fact_auth_events", schemas.STORED_EVENTS).drop("load"),
        calendar,
    )
