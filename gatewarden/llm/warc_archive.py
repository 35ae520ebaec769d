"""A content-addressed web archive: payload bytes once, exact record heads apart.

``write_archive`` stores two tables in a shared folder. ``payloads`` has each
different payload once under its SHA-256 address; ``heads`` has one row per
record, the exact bytes of its WARC and HTTP head and the address. Of records
with equal payloads of at least 1000 bytes the one with the largest page id is
a response and the others revisit it; smaller ones are all responses.
``read_records`` joins both, gives every record's original bytes, checks each
stored payload against its address and each response against its head.

Defined cases: a null html is an empty payload; a null url leaves its head line
out; a null page id is smaller than any other; repeated rows with the largest id
are all responses; empty tables give empty archives. Extra columns are not stored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewarden.functions.shared import shared_folder

MIN_REVISIT_BYTES = 1000
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The tables have no fetch time; an archive states the time it was made with.
DATE = "2024-01-01T00:00:00Z"


def _line(name: str, value: Column) -> Column:
    """One head line, nothing if the value is null; line breaks cannot end it."""
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _head(date: str) -> Column:
    """The WARC head and the HTTP head, up to the payload's first byte."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
        _line("Content-Length", F.col("payload_bytes")), F.lit(CRLF),
    )
    block = F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Refers-To", F.when(F.col("revisit"), _record_id(F.col("original")))),
        _line("WARC-Profile", F.when(F.col("revisit"), F.lit(PROFILE))),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _line("Content-Length", block), F.lit(CRLF), http,
    ).cast("binary")


def write_archive(pages: DataFrame, folder: str, date: str = DATE) -> None:
    """Write ``folder``/payloads and ``folder``/heads; the folder must be shared and new."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    hashed = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "address", F.sha2("payload", 256)
    )
    # Copies are merged before the shuffle: a task sends each payload once.
    stored = hashed.groupBy("address").agg(
        F.max("page_id").alias("original"), F.any_value("payload").alias("payload")
    )
    (
        stored.withColumn("sha1", F.sha1("payload"))
        .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
        .write.parquet(f"{folder}/payloads")
    )
    facts = spark.read.parquet(f"{folder}/payloads").drop("payload")
    larger = F.col("page_id").eqNullSafe(F.col("original"))
    heads = (
        hashed.drop("payload").join(facts, "address")
        .withColumn("revisit", (F.col("payload_bytes") >= MIN_REVISIT_BYTES) & ~larger)
        .select("address", _head(date).alias("head"))
    )
    heads.write.parquet(f"{folder}/heads")


def _field(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, rf"\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record: its fields, its exact bytes and what is known of its payload.

    ``record`` ends with the two line ends that close a WARC record. A payload
    whose SHA-256 is not its address, or a response whose payload does not have
    the digest its head states, fails the job.
    """
    payloads = spark.read.parquet(f"{folder}/payloads").select("address", "payload")
    text = F.col("head").cast("string")
    heads = spark.read.parquet(f"{folder}/heads").select(
        "address", "head",
        _field(text, "WARC-Type").alias("record_type"),
        F.regexp_extract(_field(text, "WARC-Record-ID"), r"<urn:page:(-?\d+)>", 1).alias("own"),
        F.regexp_extract(F.coalesce(_field(text, "WARC-Refers-To"), F.lit("")), r"<urn:page:(-?\d+)>", 1).alias("first"),
        F.substring_index(_field(text, "WARC-Payload-Digest"), ":", -1).alias("stated"),
        _field(text, "WARC-Target-URI").alias("url"),
    )
    verified = payloads.select(
        "address",
        F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("stored payload differs from "), F.col("address"))).cast("binary"))
        .alias("payload"),
    )
    is_response = F.col("record_type") == "response"
    end = F.lit((CRLF * 2).encode())
    # Only responses carry bytes; a revisit is its head, and takes the payload's facts from the store.
    responses = heads.where(is_response).join(verified, "address").select(
        *heads.columns, F.concat("head", "payload", end).alias("record"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
    )
    facts = verified.select(
        "address", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")
    )
    revisits = heads.where(~is_response).join(facts, "address").select(
        *heads.columns, F.concat("head", end).alias("record"), "payload_bytes", "payload_digest"
    )
    return responses.unionByName(revisits).select(
        F.when(F.col("own") != "", F.col("own").cast("long")).alias("page_id"), "url", "record_type",
        F.when(F.col("first") != "", F.col("first").cast("long")).alias("refers_to"),
        "payload_bytes",
        F.when(F.col("payload_digest") == F.col("stated"), F.col("payload_digest"))
        .otherwise(F.raise_error(F.lit("payload differs from its head")))
        .alias("payload_digest"),
        "record",
    )


def op7_warc_archive(pages: DataFrame) -> DataFrame:
    """Archive all pages in the shared folder, read the records back, one row per page."""
    spark = pages.sparkSession
    folder = (
        f"{shared_folder(spark).rstrip('/')}/gatewarden/{spark.sparkContext.applicationId}"
        f"/{uuid.uuid4().hex}"
    )
    write_archive(pages, folder)
    records = read_records(spark, folder)
    # The digest below is of the bytes of the record read back, not of the table.
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        F.octet_length("record").cast("long").alias("record_bytes"),
    )
