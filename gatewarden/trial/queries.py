"""Registered queries: each takes the trial star and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import lru_cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewarden.operators import accounts, assets, brute_force, compromise, external
from gatewarden.operators import risk_profiles, rolling_attacks, scenarios, temporal
from gatewarden.plans import dashboard, executive, hunts
from gatewarden.sources import quality
from gatewarden.trial import load_queries
from gatewarden.sources.trial_tables import trial_warehouse
from gatewarden.functions.addresses import with_address_columns
from gatewarden.sources.warehouse import Warehouse, with_event_defaults

FLOOR = "2024-01-08"
AS_OF = "2024-01-31 00:00:00"
GENERATED_AT = "2024-01-31T00:00:00"

def _reparsed(wh: Warehouse) -> DataFrame:
    """The events with some other address texts, and the columns parsed from them."""
    text = (
        F.when(F.col("event_id") % 7 == 0, "300.1.2.3")
        .when(F.col("event_id") % 11 == 0, "2001:db8::1")
        .otherwise(F.col("source_ip"))
    )
    plain = wh.events.drop("source_ip_num", "is_external").withColumn("source_ip", text)
    return with_address_columns(plain)


def _loaded(wh: Warehouse) -> DataFrame:
    """The events as loading stores them, from masked addresses and missing types."""
    raw = wh.events.drop("source_ip_num", "is_external").withColumns({
        "source_ip": F.concat("source_ip", F.lit("/32")),
        "event_type": F.expr("nullif(event_type, 'logout')"),
    })
    return with_event_defaults(raw).select(
        "event_id", "source_ip", "event_type", "event_date", "is_external"
    )


JOBS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "brute_force": partial(brute_force.brute_force, since=FLOOR),
    "password_spraying": partial(brute_force.password_spraying, since=FLOOR),
    "compromise_same_ip": compromise.compromised_same_address,
    "compromise_same_ip_left": partial(
        compromise.compromised_same_address, keep_unknown_hosts=True,
        failed_after="2024-01-17 00:00:00",
    ),
    "compromise_any_ip": compromise.compromised_any_address,
    "critical_asset_attacks": partial(assets.critical_asset_attacks, since=FLOOR),
    "critical_asset_attacks_by_text": partial(assets.critical_asset_attacks_by_text, since=FLOOR),
    "critical_asset_summary": partial(assets.critical_asset_summary, since=FLOOR),
    "critical_asset_hunt": partial(assets.critical_asset_hunt, since=FLOOR),
    "critical_assets_dashboard": partial(assets.critical_assets_dashboard, since=FLOOR),
    "privileged_audit": partial(accounts.privileged_audit, since=FLOOR),
    "privileged_audit_inner": partial(
        accounts.privileged_audit, since=FLOOR, keep_unknown_hosts=False
    ),
    "external_ip_summary": partial(external.external_ip_summary, since=FLOOR),
    "external_ip_summary_inner": partial(external.external_ip_summary_known_hosts, since=FLOOR),
    "external_threats_hunt": partial(external.external_threats, min_attempts=10, since=FLOOR),
    "threat_actors": partial(external.threat_actors, since=FLOOR),
    "account_activity": partial(accounts.account_activity, since=FLOOR),
    "attacks_by_hour": partial(temporal.attacks_by_hour, since=FLOOR),
    "hourly_attacks_dashboard": partial(temporal.hourly_attacks, since=FLOOR),
    "business_hours_comparison": partial(temporal.business_hours_comparison, since=FLOOR),
    "business_hours_dashboard": partial(temporal.business_hours_dashboard, since=FLOOR),
    "day_of_week_pattern": partial(temporal.day_of_week_pattern, since=FLOOR),
    "day_of_week_dashboard": partial(temporal.day_of_week_dashboard, since=FLOOR),
    "high_risk_period_attacks": partial(temporal.high_risk_period_attacks, since=FLOOR),
    "night_shift_anomalies": partial(
        temporal.night_shift_anomalies, since=FLOOR, expected=("MACHINERY", "HOUSEHOLD")
    ),
    "hourly_heatmap": partial(temporal.hourly_heatmap, since=FLOOR),
    "privileged_off_hours": partial(temporal.privileged_off_hours, since=FLOOR),
    "privileged_off_hours_detail": temporal.privileged_off_hours_detail,
    "spray_by_hour": partial(temporal.spray_by_hour, threshold=68),
    "department_night_logins": partial(temporal.department_night_logins, department="BUILDING"),
    "scenario_classification": partial(scenarios.scenario_classification, since=FLOOR),
    "kpi_summary": partial(scenarios.kpi_summary, since=FLOOR),
    "event_timeline": partial(accounts.event_timeline, since=FLOOR),
    "executive_dashboard": partial(executive.executive_dashboard, since=FLOOR),
    "soc_dashboard_records": lambda wh: dashboard.dashboard_records(wh, FLOOR, True).select(
        "section", "rank", "record"
    ),
    "soc_dashboard_document": lambda wh: dashboard.dashboard_document(wh, GENERATED_AT, FLOOR),
    "soc_dashboard_temporal_document": lambda wh: dashboard.dashboard_document(
        wh, GENERATED_AT, FLOOR, temporal=True
    ),
    "hunt_brute_force": partial(hunts.hunt_brute_force, as_of=AS_OF, days=10),
    "hunt_brute_force_user": partial(
        hunts.hunt_brute_force, as_of=AS_OF, username="Customer#000000021", threshold=2, days=30
    ),
    "hunt_password_spraying": partial(hunts.hunt_password_spraying, as_of=AS_OF, days=14),
    "hunt_password_spraying_ip": partial(
        hunts.hunt_password_spraying, as_of=AS_OF, ip_address="198.51.1.66", threshold=3, days=30
    ),
    "hunt_compromises": partial(hunts.hunt_compromises, as_of=AS_OF, days=21),
    "hunt_external_threats": partial(
        hunts.hunt_external_threats, as_of=AS_OF, min_attempts=5, days=7
    ),
    "hunt_privileged_activity": partial(hunts.hunt_privileged_activity, as_of=AS_OF, hours=72),
    "hunt_privileged_activity_user": partial(
        hunts.hunt_privileged_activity, as_of=AS_OF, username="Customer#000000008", hours=240
    ),
    "hunt_critical_assets": partial(hunts.hunt_critical_assets, as_of=AS_OF, days=7),
    "sprayed_accounts": partial(risk_profiles.sprayed_accounts, since=FLOOR),
    "rolling_brute_force": partial(
        rolling_attacks.rolling_brute_force, seconds=86400, threshold=2, since=FLOOR
    ),
    "spray_urgency": partial(rolling_attacks.spray_urgency, threshold=3, since=FLOOR),
    "brute_force_by_privilege": partial(rolling_attacks.brute_force_by_privilege, since=FLOOR),
    "distributed_brute_force": partial(
        rolling_attacks.distributed_brute_force, threshold=2, since=FLOOR
    ),
    "logins_after_recent_failures": partial(
        rolling_attacks.logins_after_recent_failures, seconds=86400, since=FLOOR
    ),
    "spray_outcomes": partial(risk_profiles.spray_outcomes, since=FLOOR),
    "critical_asset_outcomes": partial(risk_profiles.critical_asset_outcomes, since=FLOOR),
    "external_threat_levels": partial(risk_profiles.external_threat_levels, since=FLOOR),
    "account_anomalies": partial(risk_profiles.account_anomalies, since=FLOOR),
    "session_durations": partial(rolling_attacks.session_durations, since=FLOOR),
    "concurrent_addresses": partial(rolling_attacks.concurrent_addresses, since=FLOOR),
    "external_ip_summary_private_ranges": partial(
        risk_profiles.external_ip_summary_private_ranges, since=FLOOR
    ),
    "activity_spikes": partial(risk_profiles.activity_spikes, since=FLOOR),
    "peer_comparison": partial(risk_profiles.peer_comparison, since=FLOOR),
    "dormant_accounts": partial(risk_profiles.dormant_accounts, as_of=AS_OF, days=2),
    "shift_activity": partial(
        risk_profiles.shift_activity, holidays=(date(2024, 1, 15),), since=FLOOR
    ),
    "week_over_week": partial(risk_profiles.week_over_week, since=FLOOR),
    "quarterly_trend": risk_profiles.quarterly_trend,
    "external_daily_activity": partial(risk_profiles.external_daily_activity, since=FLOOR),
    "lateral_movement": partial(
        risk_profiles.lateral_movement, hosts=9, levels=4, expected=("MACHINERY",), since=FLOOR
    ),
    "calendar": temporal.calendar_of,
    "calendar_span": lambda wh: temporal.calendar_span(temporal.calendar_of(wh)),
    "calendar_day": lambda wh: temporal.calendar_day(temporal.calendar_of(wh), "2024-01-20"),
    "calendar_coverage": quality.calendar_coverage,
    "constraint_violations": quality.constraint_violations,
    "parsed_addresses": lambda wh: _reparsed(wh).select(
        "event_id", "source_ip", "source_ip_num", "is_external"
    ),
    "unreadable_addresses": lambda wh: quality.unreadable_addresses(
        wh.with_events(_reparsed(wh))
    ).select("event_id", "source_ip"),
    "loaded_events": lambda wh: _loaded(wh),
    # dimensions that lack some of their rows
    "orphan_events": lambda wh: quality.orphan_events(replace(
        wh, users=wh.users.filter("department IS NOT NULL"),
        hosts=wh.hosts.filter("asset_criticality <> 'LOW'"),
    )).select("event_id", "missing"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    opened = lru_cache(maxsize=4)(trial_warehouse)

    def bound(job):
        return lambda spark, sf_dir: job(opened(spark, sf_dir))

    return {name: bound(job) for name, job in (JOBS | load_queries.JOBS).items()}
