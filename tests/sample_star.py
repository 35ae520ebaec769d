"""A small star with known attacks, and edge rows to add to it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from gatewarden.functions.clock import Calendar
from gatewarden.sources import schemas
from gatewarden.sources.warehouse import Warehouse

# user_id, username, department, is_privileged.
USERS = [
    (1, "jsmith", "Finance", False),
    (2, "dbaker", "Engineering", False),
    (3, "mjones", "Marketing", False),
    (4, "kwilson", "Finance", False),
    (5, "tgarcia", "Sales", False),
    (6, "rjohnson", "Sales", False),
    (7, "schen", "Engineering", False),
    (8, "lbrown", "IT Support", False),
    (9, "admin", "IT Security", True),
    (10, "jdoe-admin", "IT Security", True),
    (11, "svc-backup", "IT Ops", True),
]

# host_id, hostname, asset_criticality, location.
HOSTS = [
    (1, "dc-corp-01", "CRITICAL", "Office - NY"),
    (2, "database-prod-01", "CRITICAL", "AWS us-east-1"),
    (3, "vpn-gateway", "HIGH", "AWS us-east-1"),
    (4, "webserver-prod-01", "HIGH", "AWS us-east-1"),
    (5, "fileserver-corp", "MEDIUM", "Office - NY"),
    (6, "laptop-dbaker", "LOW", "Remote"),
    (7, "laptop-jsmith", "LOW", "Remote"),
    (8, "laptop-schen", "LOW", "Remote"),
    (9, "laptop-kwilson", "LOW", "Remote"),
]

# User, host, address, event type, success, time.
EVENTS = [
    (1, 1, "198.51.100.42", "failed_login", False, "2025-01-19 03:45:10"),
    (2, 4, "198.51.100.42", "failed_login", False, "2025-01-19 03:45:25"),
    (6, 1, "198.51.100.42", "failed_login", False, "2025-01-19 03:45:40"),
    (3, 2, "198.51.100.42", "failed_login", False, "2025-01-19 03:45:55"),
    (7, 2, "198.51.100.42", "failed_login", False, "2025-01-19 03:46:10"),
    (5, 1, "198.51.100.42", "failed_login", False, "2025-01-19 03:46:25"),
    (4, 3, "198.51.100.42", "failed_login", False, "2025-01-19 03:46:40"),
    (8, 1, "198.51.100.42", "failed_login", False, "2025-01-19 03:46:55"),
    (9, 4, "185.220.101.47", "failed_login", False, "2025-01-20 14:30:00"),
    (9, 4, "185.220.101.47", "failed_login", False, "2025-01-20 14:30:15"),
    (9, 4, "185.220.101.47", "failed_login", False, "2025-01-20 14:30:30"),
    (9, 4, "185.220.101.47", "failed_login", False, "2025-01-20 14:30:45"),
    (9, 4, "185.220.101.47", "login", True, "2025-01-20 14:31:00"),
    (2, 1, "10.0.3.78", "failed_login", False, "2025-01-20 16:30:00"),
    (2, 1, "10.0.3.78", "failed_login", False, "2025-01-20 16:31:00"),
    (2, 2, "10.0.3.78", "failed_login", False, "2025-01-20 16:32:00"),
    (2, 6, "10.0.3.78", "login", True, "2025-01-20 16:35:00"),
    (4, 3, "10.0.1.50", "failed_login", False, "2025-01-18 22:15:00"),
    (4, 4, "10.0.1.50", "failed_login", False, "2025-01-18 22:20:00"),
    (4, 6, "10.0.1.50", "login", True, "2025-01-20 09:10:00"),
    (4, 8, "10.0.1.50", "login", True, "2025-01-20 09:12:00"),
    (4, 2, "10.0.1.50", "login", True, "2025-01-20 09:15:00"),
    (5, 1, "73.241.12.56", "login", True, "2025-01-20 08:30:00"),
    (3, 2, "67.180.93.22", "login", True, "2025-01-20 09:45:00"),
    (1, 7, "203.0.113.88", "login", True, "2025-01-20 02:15:00"),
    (7, 8, "10.0.2.15", "login", True, "2025-01-20 15:35:00"),
    (10, 2, "10.0.1.100", "login", True, "2025-01-20 10:00:00"),
    (10, 2, "10.0.1.100", "logout", True, "2025-01-20 11:45:00"),
    (11, 2, "10.10.5.20", "login", True, "2025-01-18 02:00:00"),
    (11, 5, "10.10.5.20", "login", True, "2025-01-18 02:05:00"),
    (11, 5, "10.10.5.20", "logout", True, "2025-01-18 02:30:00"),
    (11, 2, "10.10.5.20", "login", True, "2025-01-19 02:00:00"),
    (11, 5, "10.10.5.20", "login", True, "2025-01-19 02:05:00"),
    (11, 5, "10.10.5.20", "logout", True, "2025-01-19 02:30:00"),
    (11, 2, "10.10.5.20", "login", True, "2025-01-20 02:00:00"),
    (11, 5, "10.10.5.20", "login", True, "2025-01-20 02:05:00"),
    (11, 5, "10.10.5.20", "logout", True, "2025-01-20 02:30:00"),
    (8, 3, "10.50.2.10", "failed_login", False, "2025-01-19 03:46:55"),
    (8, 3, "45.142.212.61", "failed_login", False, "2025-01-20 02:20:00"),
    (8, 1, "203.0.113.88", "login", True, "2025-01-20 02:25:40"),
    (8, 4, "67.180.93.22", "login", True, "2025-01-20 14:10:00"),
    (8, 2, "103.28.48.12", "login", True, "2025-01-20 14:25:00"),
    (1, 7, "10.0.1.25", "failed_login", False, "2025-01-20 14:20:00"),
    (1, 7, "10.0.1.25", "login", True, "2025-01-20 14:20:15"),
    (3, 2, "10.0.2.30", "failed_login", False, "2025-01-20 17:30:00"),
    (3, 2, "10.0.2.30", "login", True, "2025-01-20 17:30:20"),
]

KINDS = {"F": ("failed_login", False), "S": ("login", True), "O": ("logout", True)}


def event(event_id: int, user_id: int, host_id: int | None, address: str, outcome: str,
          when: str) -> tuple:
    kind, success = KINDS[outcome]
    moment = datetime.fromisoformat(when)
    return (event_id, user_id, host_id, address, kind, success, moment, moment)


def sample_events() -> list[tuple]:
    rows = []
    for number, (user, host, address, kind, success, when) in enumerate(EVENTS, 1):
        moment = datetime.fromisoformat(when)
        rows.append((number, user, host, address, kind, success, moment, moment))
    return rows


def frame_of_users(spark: SparkSession, rows=USERS) -> DataFrame:
    return spark.createDataFrame([(*row, None, None) for row in rows], schemas.USERS)


def frame_of_hosts(spark: SparkSession, rows=HOSTS) -> DataFrame:
    return spark.createDataFrame([(*row, None, None) for row in rows], schemas.HOSTS)


def frame_of_events(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, schemas.EVENTS)


def star(spark: SparkSession, extra_events=(), users=None, hosts=None, events=None,
         calendar: Calendar | None = None) -> Warehouse:
    rows = sample_events() if events is None else list(events)
    return Warehouse.of(
        frame_of_users(spark, users or USERS),
        frame_of_hosts(spark, hosts or HOSTS),
        frame_of_events(spark, rows + list(extra_events)),
        calendar or Calendar.of_year(2025),
    )


def tuples(frame: DataFrame, *columns: str) -> list[tuple]:
    chosen = frame.select(*columns) if columns else frame
    return [tuple(row) for row in chosen.collect()]


def at(day: int, clock: str) -> datetime:
    return datetime.fromisoformat(f"2025-01-{day:02d} {clock}")
