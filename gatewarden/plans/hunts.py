"""The six hunts with their arguments. ``as_of`` is the end of the look-back; None is now."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gatewarden.operators.accounts import privileged_audit
from gatewarden.operators.assets import critical_asset_hunt
from gatewarden.operators.brute_force import brute_force, password_spraying
from gatewarden.operators.compromise import compromised_same_address
from gatewarden.operators.external import external_threats
from gatewarden.sources.warehouse import Warehouse, lookback_start


def hunt_brute_force(wh: Warehouse, as_of: str | None = None, username: str | None = None,
                     threshold: int = 3, days: int = 1) -> DataFrame:
    return brute_force(wh.looking_back(as_of, days=days), threshold, None, username)


def hunt_password_spraying(wh: Warehouse, as_of: str | None = None,
                           ip_address: str | None = None, threshold: int = 5,
                           days: int = 1) -> DataFrame:
    return password_spraying(wh.looking_back(as_of, days=days), threshold, None, ip_address)


def hunt_compromises(wh: Warehouse, as_of: str | None = None, days: int = 7) -> DataFrame:
    """The look-back limits the failures; the host of the success may be unknown."""
    return compromised_same_address(
        wh, keep_unknown_hosts=True, failed_after=lookback_start(as_of, days=days)
    )


def hunt_external_threats(wh: Warehouse, as_of: str | None = None, min_attempts: int = 1,
                          days: int = 30) -> DataFrame:
    return external_threats(wh.looking_back(as_of, days=days), min_attempts)


def hunt_privileged_activity(wh: Warehouse, as_of: str | None = None,
                             username: str | None = None, hours: int = 24) -> DataFrame:
    return privileged_audit(wh.looking_back(as_of, hours=hours), None, username)


def hunt_critical_assets(wh: Warehouse, as_of: str | None = None, days: int = 7) -> DataFrame:
    return critical_asset_hunt(wh.looking_back(as_of, days=days), None)


HUNTS = {
    "brute_force": hunt_brute_force,
    "password_spraying": hunt_password_spraying,
    "compromises": hunt_compromises,
    "external_threats": hunt_external_threats,
    "privileged_activity": hunt_privileged_activity,
    "critical_assets": hunt_critical_assets,
}


def exit_status(findings: DataFrame) -> int:
    """1 when the hunt found something, else 0, for job schedulers."""
    return 0 if findings.isEmpty() else 1
