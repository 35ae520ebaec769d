"""Addresses of both families as 128 bits, and the longest network of a table that holds them.

An address is 32 hexadecimal digits; IPv4 addresses are the mapped ones of IPv6
(``::ffff:0:0/96``), so both families share one order and one join. The join explodes each different
address once per prefix length in use (never more than 129) and meets the networks by
equality of length and prefix: no ranges, no cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.addresses import IPV4_PATTERN
from gatewarden.functions.shared import computed_once
from gatewarden.functions.skew import lookup_join

MAPPED = "0" * 20 + "ffff"
WIDTH = 128


def _ipv4_hex(text: Column) -> Column:
    """Eight digits of valid IPv4 text."""
    return F.array_join(F.transform(F.split(text, r"\."), lambda o: F.lpad(F.lower(F.hex(o.cast("int"))), 2, "0")), "")


def address_hex(text: Column) -> Column:
    """The 32 digits of an IPv4 or IPv6 text; NULL for anything else, zones included."""
    plain = F.lower(F.trim(text))
    # An IPv4 ending stands for the last two groups.
    ending = F.regexp_extract(plain, r":([0-9]+(\.[0-9]+){3})$", 1)
    four = F.when(ending.rlike(IPV4_PATTERN), _ipv4_hex(ending))
    grouped = F.when(ending == "", plain).otherwise(F.concat(
        F.substring(plain, F.lit(1), F.char_length(plain) - F.char_length(ending)),
        F.substring(four, 1, 4), F.lit(":"), F.substring(four, 5, 4),
    ))
    halves = F.split(grouped, "::")

    def groups(half: Column) -> Column:
        return F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":"))

    left, right = groups(halves[0]), groups(F.coalesce(F.get(halves, F.lit(1)), F.lit("")))
    missing = 8 - F.size(left) - F.size(right)
    filled = F.concat(left, F.array_repeat(F.lit("0"), missing), right)
    whole = F.when(F.size(halves) == 1, left).when((F.size(halves) == 2) & (missing > 0), filled)
    valid = (F.size(whole) == 8) & F.forall(whole, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
    six = F.when(valid, F.array_join(F.transform(whole, lambda g: F.lpad(g, 4, "0")), ""))
    return F.when(plain.rlike(IPV4_PATTERN), F.concat(F.lit(MAPPED), _ipv4_hex(plain))).when(F.contains(plain, F.lit(":")), six)


def prefix_of(digits: Column, length: Column) -> Column:
    """The first ``length`` bits: whole digits as they are, and the value of the bits of the next one."""
    whole = F.floor(length / 4).cast("int")
    rest = F.pmod(length, F.lit(4)).cast("int")
    last = F.conv(F.substring(digits, whole + 1, F.lit(1)), 16, 10).cast("int")
    bits = F.when(rest == 1, F.shiftright(last, 3)).when(rest == 2, F.shiftright(last, 2)).when(rest == 3, F.shiftright(last, 1))
    return F.concat(F.substring(digits, F.lit(1), whole), F.lit("/"), F.coalesce(bits, F.lit(0)).cast("string"))


def with_prefixes(networks: DataFrame, network: str = "network") -> DataFrame:
    """Add ``length`` and ``prefix`` to networks in CIDR text; a text without a length is one address.

    Bits behind the length are ignored. Texts that are no network, or repeat one, raise no error:
    the first are left out and of the others the rows stay as they are.
    """
    parts = F.split(F.trim(network), "/")
    digits = address_hex(parts[0])
    own = F.when(F.contains(parts[0], F.lit(":")), WIDTH).otherwise(32)
    given = F.coalesce(F.get(parts, F.lit(1)).try_cast("int"), F.when(F.size(parts) == 1, own))
    length = F.when((F.size(parts) <= 2) & given.between(0, own), given + WIDTH - own)
    return (
        networks.withColumns({"length": length, "_digits": digits})
        .where(F.col("length").isNotNull() & F.col("_digits").isNotNull())
        .withColumn("prefix", prefix_of(F.col("_digits"), F.col("length"))).drop("_digits")
    )


def longest_networks(addresses: DataFrame, networks: DataFrame, address: str = "source_ip",
                     network: str = "network") -> DataFrame:
    """``address`` and ``network``: the longest network that holds each different address, NULL if none.

    Of equal networks written differently the first by text is named.
    """
    table = computed_once(
        with_prefixes(networks.select(network), network).groupBy("length", "prefix").agg(F.min(network).alias(network))
    )
    lengths = [r["length"] for r in table.select("length").distinct().orderBy("length").collect()]  # at most 129
    known = computed_once(addresses.select(address).where(F.col(address).isNotNull()).distinct().withColumn("_digits", address_hex(F.col(address))))
    if not lengths:
        return known.select(address, F.lit(None).cast("string").alias(network))
    tried = known.where(F.col("_digits").isNotNull()).withColumn("length", F.explode(F.array(*map(F.lit, lengths)))).select(
        address, "length", prefix_of(F.col("_digits"), F.col("length")).alias("prefix")
    )
    # A network that holds very many addresses is met by many rows: measured, then broadcast or salted.
    met = lookup_join(
        tried, table, ["length", "prefix"],
        lambda: tried.groupBy("length", "prefix").agg(F.count("*").alias("weight")), row_id=address,
    )
    best = met.groupBy(address).agg(F.max_by(network, "length").alias(network))
    return known.select(address).join(best, address, "left")
