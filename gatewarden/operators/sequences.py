"""Attacks as ordered steps: spraying, then a login, then other hosts, each within a span of the one before.

A step is told from the latest earlier step of its key. Events are collapsed to seconds
first and never joined to each other; time is cut into spans, so what a window holds
is bounded by the span, whatever the key (``functions/rolling.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.rolling import distinct_trailing, latest_before, moment, second_cells
from gatewarden.functions.shared import computed_once
from gatewarden.operators import FLOOR
from gatewarden.sources.warehouse import Warehouse

HOUR = 3600
DAY = 86400


def _entries(wh: Warehouse, threshold: int, spray_seconds: int, seconds: int, since: str | None) -> DataFrame:
    """source_ip, user_id, dest_host_id, second, sprayed_at, failed_at, users_targeted, logins.

    A login counts if its address sprayed in the ``seconds`` before, and the user was among those it
    failed against in the same time. Failures of the login's own second do not count.
    """
    cells = computed_once(second_cells(
        wh.events_since(since), "source_ip", "user_id",
        failures=F.count_if(~F.col("success")), logins=F.count_if("success"),
    ))
    failed = cells.where("failures > 0")
    sprays = (
        distinct_trailing(failed, ["source_ip"], "user_id", spray_seconds, "users_targeted")
        .where(F.col("users_targeted") >= threshold)
    )
    # Only addresses that spray at all go on; they are few, and their rows meet them by address.
    sprayers = computed_once(sprays)
    suspects = cells.join(sprayers.select("source_ip").distinct(), "source_ip", "left_semi")
    pairs = latest_before(suspects, ["source_ip", "user_id"], seconds, F.col("failures") > 0, "failed_at").where(
        (F.col("logins") > 0) & F.col("failed_at").isNotNull()
    )
    asked = pairs.groupBy("source_ip", "second").agg(F.lit(None).cast("bigint").alias("users_targeted"))
    marks = asked.unionByName(sprayers.select("source_ip", "second", "users_targeted")).groupBy("source_ip", "second").agg(
        F.max("users_targeted").alias("users_targeted")
    )
    known = latest_before(
        marks, ["source_ip"], seconds, F.col("users_targeted").isNotNull(), "spray",
        F.struct(F.col("second").alias("sprayed_at"), F.col("users_targeted").alias("users")),
    ).where(F.col("spray").isNotNull()).select("source_ip", "second", "spray")
    return pairs.join(known, ["source_ip", "second"]).select(
        "source_ip", "user_id", "second", "failed_at", F.col("spray.sprayed_at").alias("sprayed_at"),
        F.col("spray.users").alias("users_targeted"), "logins",
    )


def spray_entries(wh: Warehouse, threshold: int = 5, spray_seconds: int = HOUR, seconds: int = DAY,
                  since: str | None = FLOOR) -> DataFrame:
    """Logins of sprayed users from the spraying address, after the spraying.

    → source_ip, username, users_targeted, sprayed_at, entered_at, logins. ``sprayed_at`` is the
    latest second before the login at which the address had failed against ``threshold`` users
    within ``spray_seconds``. A login before the spraying, or more than ``seconds`` after it, is none.
    """
    return (
        _entries(wh, threshold, spray_seconds, seconds, since)
        .join(wh.users.select("user_id", "username"), "user_id")
        .select(
            "source_ip", "username", "users_targeted", moment(F.col("sprayed_at")).alias("sprayed_at"),
            moment(F.col("second")).alias("entered_at"), "logins",
        )
        .orderBy("entered_at", "source_ip", "username")
    )


def spray_movements(wh: Warehouse, threshold: int = 5, spray_seconds: int = HOUR, seconds: int = DAY,
                    since: str | None = FLOOR) -> DataFrame:
    """Hosts that a user reached after being entered by spraying, within ``seconds`` of the entry.

    → username, source_ip (of the latest entry), entered_at, hostname, asset_criticality, moved_at (first
    login there), logins. An entry second of several addresses goes to the greatest of them.
    """
    entries = _entries(wh, threshold, spray_seconds, seconds, since).groupBy("user_id", "second").agg(
        F.max("source_ip").alias("entry_ip")
    )
    entries = computed_once(entries)
    logins = (
        second_cells(
            wh.events_since(since).where(F.col("success") & F.col("dest_host_id").isNotNull()),
            "user_id", "dest_host_id", logins=F.count("*"),
        )
        .join(entries.select("user_id").distinct(), "user_id", "left_semi")
        .withColumn("entry_ip", F.lit(None).cast("string"))
    )
    both = logins.unionByName(entries.selectExpr("user_id", "NULL AS dest_host_id", "second", "NULL AS logins", "entry_ip"))
    after = latest_before(
        both, ["user_id"], seconds, F.col("entry_ip").isNotNull(), "entry",
        F.struct(F.col("second").alias("entered_at"), F.col("entry_ip").alias("ip")),
    ).where(F.col("logins").isNotNull() & F.col("entry").isNotNull())
    hosts = wh.hosts.select(F.col("host_id").alias("dest_host_id"), "hostname", "asset_criticality")
    return (
        after.groupBy("user_id", "entry", "dest_host_id")
        .agg(F.min("second").alias("moved"), F.sum("logins").alias("logins"))
        .join(wh.users.select("user_id", "username"), "user_id").join(hosts, "dest_host_id")
        .select(
            "username", F.col("entry.ip").alias("source_ip"), moment(F.col("entry.entered_at")).alias("entered_at"),
            "hostname", "asset_criticality", moment(F.col("moved")).alias("moved_at"), "logins",
        )
        .orderBy("entered_at", "username", "hostname")
    )
