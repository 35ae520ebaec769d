"""Scopes from a table of networks: internal or external, by the longest network that holds an address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.networks import longest_networks
from gatewarden.functions.shared import computed_once
from gatewarden.functions.skew import lookup_join
from gatewarden.operators import FLOOR
from gatewarden.sources.warehouse import Warehouse

UNLISTED = "unlisted"


def address_zones(addresses: DataFrame, networks: DataFrame) -> DataFrame:
    """source_ip, network, zone, is_internal of each different address; an unlisted one is external.

    ``networks`` has network (CIDR text), zone and is_internal; of equal networks the first by zone counts.
    """
    found = longest_networks(addresses, networks)
    labels = networks.groupBy("network").agg(F.min(F.struct("zone", "is_internal")).alias("label"))
    return found.join(labels, "network", "left").select(
        "source_ip", "network", F.coalesce("label.zone", F.lit(UNLISTED)).alias("zone"),
        F.coalesce("label.is_internal", F.lit(False)).alias("is_internal"),
    )


def zone_activity(wh: Warehouse, networks: DataFrame, since: str | None = FLOOR) -> DataFrame:
    """Per network: its zone, events, failures, addresses and users seen.

    → network, zone, is_internal, total_attempts, failed_attempts, unique_ips, unique_users. Events
    collapse to (address, user) before their address is looked up.
    """
    cells = computed_once(
        wh.events_since(since).groupBy("source_ip", "user_id").agg(
            F.count("*").alias("events"), F.count_if(~F.col("success")).alias("failures")
        )
    )
    zones = computed_once(address_zones(cells, networks))
    placed = lookup_join(
        cells, zones, ["source_ip"], lambda: cells.groupBy("source_ip").agg(F.count("*").alias("weight")), row_id="user_id",
    )
    keys = ["network", "zone", "is_internal"]
    users = placed.groupBy(*keys, "user_id").agg(F.sum("events").alias("events"), F.sum("failures").alias("failures"))
    addresses = zones.groupBy(*keys).agg(F.count("*").alias("unique_ips"))
    totals = users.groupBy(*keys).agg(
        F.sum("events").alias("total_attempts"), F.sum("failures").alias("failed_attempts"), F.count("*").alias("unique_users")
    )
    same = [totals[k].eqNullSafe(addresses[k]) for k in keys]
    return totals.join(addresses, same).select(
        *[totals[k] for k in keys], "total_attempts", "failed_attempts", "unique_ips", "unique_users"
    ).orderBy(F.desc("total_attempts"), F.asc_nulls_last("network"))
