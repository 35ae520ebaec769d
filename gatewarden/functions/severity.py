"""Severity and class rules as expression chains; the first match wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def actor_severity(successful: Column, failed: Column, users_targeted: Column,
                   brute_failures: int = 3, spray_users: int = 5) -> Column:
    """Critical / High / Medium / Low for one source address."""
    return (
        F.when((successful > 0) & (failed >= brute_failures), "Critical")
        .when(users_targeted >= spray_users, "High")
        .when(successful > 0, "Medium")
        .otherwise("Low")
    )


def heat_level(attacks: Column, critical: int = 5, high: int = 3, medium: int = 1) -> Column:
    """Level of one cell of the weekly heat map."""
    return (
        F.when(attacks >= critical, "CRITICAL")
        .when(attacks >= high, "HIGH")
        .when(attacks >= medium, "MEDIUM")
        .otherwise("LOW")
    )


def threat_level(total: Column, failed: Column, successful: Column, users: Column,
                 first_seen: Column, last_seen: Column) -> Column:
    """CRITICAL / HIGH / MEDIUM / LOW matrix over an external address profile."""
    return (
        F.when((successful > 0) & ((failed >= 3) | (users >= 5)), "CRITICAL")
        .when(((users >= 5) & (failed >= 5)) | (total > 100), "HIGH")
        .when(((users >= 2) & (failed >= 3)) | total.between(10, 100), "MEDIUM")
        .when((users == 1) | (first_seen == last_seen), "LOW")
        .otherwise("UNRATED")
    )


def result_label(success: Column) -> Column:
    return F.when(success, "Success").otherwise("Failed")
