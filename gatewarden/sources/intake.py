"""Rejecting bad rows at load time: what the declared constraints refuse never reaches the tables.

Every incoming row is judged by all rules at once and carries the list of those it breaks.
Clean rows are appended to the facts, the others go to a table of rejects with their reasons.

Whether a key is stored already is told from bitmaps of the stored keys, never from the
facts: one bit per key, in rows of 32,768 neighbouring keys. The bitmaps of a load are merged
with those of its key ranges; a range whose bits add up to more than their union has
a repeated key, and only such ranges are unpacked and joined to the rows.

A load may run again after a failure: its facts, rejects and key bitmaps replace those of the
same load, and its own bitmaps do not count against it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewarden.functions.addresses import IPV6_PATTERN, ip_number, strip_host_mask
from gatewarden.functions.shared import computed_once
from gatewarden.functions.skew import lookup_join
from gatewarden.sources import schemas
from gatewarden.sources.warehouse import replace_load, with_event_defaults

#: Bytes of a bitmap; the built-in aggregates have this size.
BITMAP_BYTES = 4096

# Reasons in the order in which they are listed.
NO_EVENT_ID, REPEATED_IN_LOAD, STORED_BEFORE = "event_id missing", "event_id repeated in the load", "event_id stored before"
NO_USER, UNKNOWN_USER, UNKNOWN_HOST = "user_id missing", "user_id unknown", "dest_host_id unknown"
NO_ADDRESS, BAD_ADDRESS = "source_ip missing", "source_ip malformed"
NO_SUCCESS, NO_TIME = "success missing", "event_timestamp missing"

KEYS_SCHEMA = "bucket bigint, bits binary, load string"


# --- keys ---------------------------------------------------------------------------------


def key_bitmaps(rows: DataFrame, key: str = "event_id") -> DataFrame:
    """bucket, bits: one bit per key; rows without a key are left out."""
    return (
        rows.where(F.col(key).isNotNull())
        .groupBy(F.bitmap_bucket_number(key).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"))
    )


def unpacked_keys(bitmaps: DataFrame, key: str = "event_id") -> DataFrame:
    """The keys of the bitmaps, one per row."""
    octet = F.conv(F.hex(F.substring("bits", F.col("at") + 1, F.lit(1))), 16, 10).cast("int")
    return (
        bitmaps.select("bucket", "bits", F.explode(F.sequence(F.lit(0), F.lit(BITMAP_BYTES - 1))).alias("at"))
        .select("bucket", "at", octet.alias("octet")).where("octet > 0")
        .select("bucket", "at", "octet", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
        .where(F.expr("(octet >> bit) & 1 = 1"))
        .select(_key_at(F.col("bucket"), F.col("at") * 8 + F.col("bit")).alias(key))
    )


def _key_at(bucket: Column, position: Column) -> Column:
    """The key of a bit: positive keys count up from bucket 1, others down from bucket 0."""
    width = BITMAP_BYTES * 8
    return F.when(bucket > 0, (bucket - 1) * width + position + 1).otherwise(bucket * width - position).cast("bigint")


def repeated_keys(rows: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """The keys of ``rows`` that the stored bitmaps hold already.

    Bitmaps outside the load's range of buckets are skipped by the scan, those of
    other buckets by a join of bucket numbers.
    """
    own = computed_once(key_bitmaps(rows, key))
    ends = own.agg(F.min("bucket").alias("low"), F.max("bucket").alias("high")).first()
    near = stored.where(F.col("bucket").between(ends["low"], ends["high"])) if ends["low"] is not None else stored.limit(0)
    near = computed_once(
        near.join(own.select("bucket"), "bucket", "left_semi")
        .groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    )
    hit = (
        near.unionByName(own).groupBy("bucket")
        .agg(F.sum(F.bitmap_count("bits")).alias("apart"), F.bitmap_or_agg("bits").alias("bits"))
        .where(F.col("apart") > F.bitmap_count("bits")).select("bucket")
    )
    suspects = near.join(hit, "bucket", "left_semi")
    return unpacked_keys(suspects, key).join(rows.select(key).distinct(), key, "left_semi")


def stored_keys(spark: SparkSession, path: str, but_not: str | None = None) -> DataFrame:
    """The key bitmaps of a warehouse; empty if nothing was checked in yet."""
    folder = f"{path}/event_keys"
    if not _exists(spark, folder):
        return spark.createDataFrame([], KEYS_SCHEMA)
    found = spark.read.schema(KEYS_SCHEMA).parquet(folder)
    return found if but_not is None else found.where(F.col("load") != but_not)


def compact_keys(spark: SparkSession, path: str, loads: list[str], name: str) -> None:
    """Merge the bitmaps of finished loads under one ``name``, and remove theirs.

    Interrupted, it leaves some keys twice, which costs time but changes nothing.
    """
    merged = (
        stored_keys(spark, path).where(F.col("load").isin(*loads))
        .groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    )
    _write_keys(computed_once(merged), path, name)
    for load in loads:
        if load != name:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/event_keys/load={load}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _write_keys(bitmaps: DataFrame, path: str, load: str) -> None:
    (
        bitmaps.withColumn("load", F.lit(load)).repartitionByRange("bucket").sortWithinPartitions("bucket")
        .write.partitionBy("load").mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .parquet(f"{path}/event_keys")
    )


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path))


# --- events -------------------------------------------------------------------------------


def judged_events(events: DataFrame, users: DataFrame, hosts: DataFrame, stored: DataFrame) -> DataFrame:
    """The events with ``reasons``: the rules each breaks, none for a clean row.

    ``stored`` are key bitmaps (``stored_keys``). Of rows with one key, the earliest stays.
    References are checked once per value, not per row, and the values without a target, like
    repeated keys, are usually few and meet the rows where they lie.
    """
    address = strip_host_mask(F.col("source_ip"))
    rows = computed_once(events.withColumn("row_no", F.monotonically_increasing_id()))
    order = F.struct("event_timestamp", "user_id", "source_ip", "dest_host_id", "success", "row_no")
    copies = computed_once(
        rows.where("event_id is not null").groupBy("event_id")
        .agg(F.count("*").alias("weight"), F.min(order).alias("first"))
        .where("weight > 1").select("event_id", "weight", F.col("first.row_no").alias("first_row"))
    )
    before = computed_once(repeated_keys(rows, stored).withColumn("stored_before", F.lit(True)))
    no_user = _missing(rows, "user_id", users, "user_id", "no_user")
    no_host = _missing(rows, "dest_host_id", hosts, "host_id", "no_host")
    found = rows
    for lookup, key in ((copies.drop("weight"), "event_id"), (before, "event_id"), (no_user, "user_id"), (no_host, "dest_host_id")):
        weights = rows.groupBy(key).agg(F.count("*").alias("weight"))
        found = lookup_join(found, lookup, [key], lambda w=weights: w, row_id="row_no", how="left")
    rules = {
        NO_EVENT_ID: F.col("event_id").isNull(),
        REPEATED_IN_LOAD: F.col("first_row") != F.col("row_no"),
        STORED_BEFORE: F.col("stored_before"),
        NO_USER: F.col("user_id").isNull(),
        UNKNOWN_USER: F.col("no_user"),
        UNKNOWN_HOST: F.col("no_host"),
        NO_ADDRESS: F.col("source_ip").isNull(),
        BAD_ADDRESS: ip_number(address).isNull() & ~address.rlike(IPV6_PATTERN),
        NO_SUCCESS: F.col("success").isNull(),
        NO_TIME: F.col("event_timestamp").isNull(),
    }
    reasons = F.array_compact(F.array(*[F.when(broken, reason) for reason, broken in rules.items()]))
    return found.select(*events.columns, reasons.alias("reasons"))


def _missing(rows: DataFrame, column: str, dimension: DataFrame, key: str, flag: str) -> DataFrame:
    """The values of a reference that its dimension lacks, with a flag."""
    used = rows.where(F.col(column).isNotNull()).select(column).distinct()
    known = dimension.select(F.col(key).alias(column))
    return computed_once(used.join(known, column, "left_anti").withColumn(flag, F.lit(True)))


@dataclass(frozen=True)
class Outcome:
    """How many rows of a load were stored and how many rejected."""

    accepted: int
    rejected: int


def check_in(events: DataFrame, users: DataFrame, hosts: DataFrame, path: str, load: str) -> Outcome:
    """Append the clean events of a load to the facts at ``path``, and the others to its rejects.

    Keys are written before facts: a load that fails in between has to run again (as
    a stream does by itself), and meanwhile no other load can take its keys. Loads are
    checked in one after another.
    """
    spark = events.sparkSession
    judged = computed_once(judged_events(events, users, hosts, stored_keys(spark, path, but_not=load)))
    clean = judged.where(F.size("reasons") == 0).drop("reasons")
    rejects = judged.where(F.size("reasons") > 0)
    _write_keys(key_bitmaps(clean), path, load)
    replace_load(with_event_defaults(clean), path, load)
    (
        rejects.withColumn("load", F.lit(load)).write.partitionBy("load").mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").parquet(f"{path}/rejected_events")
    )
    counts = judged.agg(F.count("*").alias("rows"), F.count_if(F.size("reasons") > 0).alias("rejected")).first()
    return Outcome(counts["rows"] - counts["rejected"], counts["rejected"])


def rejected_events(spark: SparkSession, path: str) -> DataFrame:
    """All rejects with the load that brought them."""
    return spark.read.parquet(f"{path}/rejected_events")


# --- dimensions ---------------------------------------------------------------------------


def judged_users(users: DataFrame) -> DataFrame:
    """The users with ``reasons``; of rows with one user_id or username, the first by both stays."""
    return _judged_dimension(users, "user_id", "username", {})


def judged_hosts(hosts: DataFrame) -> DataFrame:
    """The hosts with ``reasons``; a criticality has to be none or one of the known ones."""
    level = F.col("asset_criticality")
    return _judged_dimension(
        hosts, "host_id", "hostname",
        {"asset_criticality not allowed": level.isNotNull() & ~level.isin(*schemas.CRITICALITIES)},
    )


def _judged_dimension(rows: DataFrame, key: str, name: str, rules: dict[str, Column]) -> DataFrame:
    """Row rules first; then of the rows that keep them, one per key and of those one per name."""
    sound = {f"{key} missing": F.col(key).isNull(), f"{name} missing": F.col(name).isNull(), **rules}
    broken = F.array_compact(F.array(*[F.when(b, r) for r, b in sound.items()]))
    marked = computed_once(rows.withColumn("row_no", F.monotonically_increasing_id()).withColumn("reasons", broken))
    clean = marked.where(F.size("reasons") == 0)
    by_key = clean.groupBy(key).agg(F.min(F.struct(name, "row_no")).alias("kept")).select("kept.row_no", F.col(f"kept.{name}"), key)
    by_name = by_key.groupBy(name).agg(F.min(F.struct(key, "row_no")).alias("kept")).select("kept.row_no")
    one_per_key = by_key.select("row_no", F.lit(True).alias("has_key"))
    one_per_name = by_name.select("row_no", F.lit(True).alias("has_name"))
    repeated = F.when(F.size("reasons") > 0, F.array().cast("array<string>")).when(
        F.col("has_key").isNull(), F.array(F.lit(f"{key} repeated"))
    ).when(F.col("has_name").isNull(), F.array(F.lit(f"{name} repeated"))).otherwise(F.array().cast("array<string>"))
    return (
        marked.join(one_per_key, "row_no", "left").join(one_per_name, "row_no", "left")
        .select(*rows.columns, F.concat("reasons", repeated).alias("reasons"))
    )
