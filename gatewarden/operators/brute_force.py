"""Brute force and password spraying."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.members import with_group_counts
from gatewarden.functions.shared import computed_once
from gatewarden.operators import FLOOR
from gatewarden.sources.warehouse import Warehouse


def failed_pairs(events: DataFrame) -> DataFrame:
    """Failures per (user, address) → failed_attempts, first_attempt, last_attempt."""
    return (
        events.filter(~F.col("success"))
        .groupBy("user_id", "source_ip")
        .agg(
            F.count("*").alias("failed_attempts"),
            F.min("event_timestamp").alias("first_attempt"),
            F.max("event_timestamp").alias("last_attempt"),
        )
    )


def brute_force(wh: Warehouse, threshold: int | Column = 3, since: str | None = FLOOR,
                username: str | None = None) -> DataFrame:
    """Accounts with ``threshold`` failures or more from one address."""
    events, users = wh.events_since(since), wh.users
    if username is not None:
        users = users.filter(F.col("username") == username)
        events = events.join(users.select("user_id"), "user_id", "left_semi")
    pairs = failed_pairs(events)
    if not isinstance(threshold, Column):
        pairs = pairs.filter(F.col("failed_attempts") >= threshold)
    found = pairs.join(users, "user_id")
    if isinstance(threshold, Column):
        found = found.filter(F.col("failed_attempts") >= threshold)
    return found.select(
        "username", "department", "is_privileged", "failed_attempts",
        "source_ip", "first_attempt", "last_attempt",
    ).orderBy(F.desc("failed_attempts"), "username", "source_ip")


def password_spraying(wh: Warehouse, threshold: int = 5, since: str | None = FLOOR,
                      ip_address: str | None = None, **join_limits) -> DataFrame:
    """Addresses failing against ``threshold`` users or more, one row per account.

    → source_ip, users_targeted, total_attempts, attack_start, attack_end,
    targeted_account. Events collapse to (address, user) before anything is
    counted per address, so counting users needs no second distinct pass.
    """
    events = wh.events_since(since)
    if ip_address is not None:
        events = events.filter(F.col("source_ip") == ip_address)
    pairs = computed_once(
        failed_pairs(events).join(wh.users.select("user_id", "username"), "user_id").drop("user_id")
    )
    groups = computed_once(
        pairs.groupBy("source_ip")
        .agg(
            F.count("*").alias("users_targeted"),
            F.sum("failed_attempts").alias("total_attempts"),
            F.min("first_attempt").alias("attack_start"),
            F.max("last_attempt").alias("attack_end"),
        )
        .filter(F.col("users_targeted") >= threshold)
    )
    members = pairs.select("source_ip", F.col("username").alias("targeted_account"))
    return (
        with_group_counts(
            members, groups, ["source_ip"], "users_targeted", "targeted_account", **join_limits
        )
        .select(
            "source_ip", "users_targeted", "total_attempts", "attack_start", "attack_end",
            "targeted_account",
        )
        .orderBy(F.desc("users_targeted"), "source_ip", "targeted_account")
    )
