"""IPv4/IPv6 text as numbers and scopes.

Addresses are compared as numbers, never as text: as text ``10.50.2.10`` sorts
after ``10.255.255.255``. The derived columns are computed once at load and
stored with the fact table, so scans can push the tests into Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PATTERN = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
IPV6_PATTERN = r"^[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*$"

# The network treated as internal, and the private IPv4 networks.
INTERNAL_NETWORK = ("10.0.0.0", "10.255.255.255")
PRIVATE_NETWORKS = (
    ("10.0.0.0", "10.255.255.255"),
    ("172.16.0.0", "172.31.255.255"),
    ("192.168.0.0", "192.168.255.255"),
)


def address_value(text: str) -> int:
    """Number of a literal IPv4 address."""
    value = 0
    for octet in text.split("."):
        value = value * 256 + int(octet)
    return value


def ip_number(text: Column) -> Column:
    """IPv4 text as a long; NULL for anything that is not a valid IPv4 address."""
    parts = F.split(text, r"\.")
    first, *rest = [F.try_element_at(parts, F.lit(i)).try_cast("long") for i in (1, 2, 3, 4)]
    value = first
    for octet in rest:
        value = value * 256 + octet
    return F.when(text.rlike(IPV4_PATTERN), value)


def in_networks(number: Column, networks) -> Column:
    """True when the numeric address lies in one of the inclusive ranges."""
    test = F.lit(False)
    for first, last in networks:
        test = test | number.between(address_value(first), address_value(last))
    return test


def external_flag(text: Column, number: Column, networks=(INTERNAL_NETWORK,)) -> Column:
    """False inside the networks, True for any other valid address, else NULL.

    IPv6 addresses rank after all IPv4 addresses, so they lie outside every
    IPv4 range and count as external.
    """
    return F.when(number.isNotNull(), ~in_networks(number, networks)).when(
        text.rlike(IPV6_PATTERN), F.lit(True)
    )


def strip_host_mask(text: Column) -> Column:
    """Drop the full-length mask some exporters append (``/32``, ``/128``)."""
    return F.regexp_replace(F.trim(text), r"/(32|128)$", "")


def with_address_columns(events: DataFrame) -> DataFrame:
    """Add ``source_ip_num`` and ``is_external`` where the table lacks them."""
    if "source_ip_num" not in events.columns:
        events = events.withColumn("source_ip_num", ip_number(F.col("source_ip")))
    if "is_external" not in events.columns:
        events = events.withColumn(
            "is_external", external_flag(F.col("source_ip"), F.col("source_ip_num"))
        )
    return events
