"""Rows at the borders of the rules, NULLs, ties and addresses."""

from pyspark.sql import functions as F

from gatewarden.functions import addresses
from gatewarden.functions.numbers import percent
from gatewarden.operators import (
    accounts, assets, brute_force, compromise, external, risk_profiles, temporal,
)
from gatewarden.sources import quality, warehouse
from gatewarden.sources.trial_tables import trial_events
from tests.sample_star import HOSTS, USERS, event, frame_of_events, star, tuples

ADDRESSES = {
    "9.255.255.255": (167772159, True),
    "10.0.0.0": (167772160, False),
    "10.50.2.10": (171049482, False),
    "10.255.255.255": (184549375, False),
    "11.0.0.0": (184549376, True),
    "255.255.255.255": (4294967295, True),
    "0.0.0.0": (0, True),
    "2001:db8::1": (None, True),
    "::1": (None, True),
    "256.1.1.1": (None, None),
    "10.0.0": (None, None),
    "10.0.0.1.2": (None, None),
    "host-7": (None, None),
    "": (None, None),
}


def test_addresses(spark):
    texts = spark.createDataFrame([(text,) for text in ADDRESSES], "source_ip string")
    rows = addresses.with_address_columns(texts).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == ADDRESSES


def test_private_networks(spark):
    texts = ["172.15.255.255", "172.16.0.0", "172.31.255.255", "172.32.0.0",
             "192.168.0.0", "192.168.255.255", "192.169.0.0", "10.1.2.3"]
    number = addresses.ip_number(F.col("ip"))
    flag = addresses.external_flag(F.col("ip"), number, addresses.PRIVATE_NETWORKS)
    frame = spark.createDataFrame([(t,) for t in texts], "ip string").select(flag)
    assert [r[0] for r in frame.collect()] == [True, False, False, True, False, False, True, False]


def test_masks_are_dropped(spark):
    frame = spark.createDataFrame([("10.0.0.1/32",), (" ::1/128 ",), ("10.0.0.1",)], "ip string")
    rows = frame.select(addresses.strip_host_mask(F.col("ip"))).collect()
    assert [r[0] for r in rows] == ["10.0.0.1", "::1", "10.0.0.1"]


def test_trial_address_columns_equal_the_computed_ones(spark):
    stored = trial_events(spark, "/root/testdata/sf0.01").select(
        "event_id", "source_ip", "source_ip_num", "is_external"
    )
    computed = addresses.with_address_columns(stored.select("event_id", "source_ip"))
    differing = stored.join(computed, "event_id").filter(
        (stored["source_ip_num"] != computed["source_ip_num"])
        | (stored["is_external"] != computed["is_external"])
        | computed["is_external"].isNull()
    )
    assert differing.isEmpty()


def test_percent_rounds_halves_up(spark):
    cases = [(21, 46, 45.7), (1, 8, 12.5), (57, 200, 28.5), (571, 2000, 28.6), (49, 400, 12.3),
             (0, 5, 0.0), (5, 5, 100.0), (1, 0, None), (10**13, 3 * 10**13, 33.3)]
    frame = spark.createDataFrame(cases, "part bigint, total bigint, expected double")
    rows = frame.select(percent(F.col("part"), F.col("total")).alias("got"), "expected").collect()
    assert [r["got"] for r in rows] == [r["expected"] for r in rows]


def test_unknown_host(spark):
    """A NULL host stays under a left join and drops out under an inner one."""
    extra = [
        event(100, 9, None, "185.220.101.47", "S", "2025-01-21 10:00:00"),
        event(101, 9, None, "185.220.101.47", "F", "2025-01-20 14:30:50"),
    ]
    wh = star(spark, extra)
    assert accounts.privileged_audit(wh).count() == 18
    assert accounts.privileged_audit(wh, keep_unknown_hosts=False).count() == 16
    summary = {r["source_ip"]: r for r in external.external_ip_summary(wh).collect()}
    assert summary["185.220.101.47"]["total_attempts"] == 7
    assert summary["185.220.101.47"]["unique_hosts_targeted"] == 1
    inner = {r["source_ip"]: r for r in external.external_ip_summary_known_hosts(wh).collect()}
    assert inner["185.220.101.47"]["total_attempts"] == 5
    assert compromise.compromised_same_address(wh).count() == 2
    left = tuples(
        compromise.compromised_same_address(wh, keep_unknown_hosts=True), "username", "target_host"
    )
    assert left[0] == ("admin", None) and len(left) == 3
    activity = {r["username"]: r for r in accounts.account_activity(wh).collect()}
    assert activity["admin"]["total_events"] == 7
    assert activity["admin"]["unique_hosts_accessed"] == 1


def test_success_must_follow_the_last_failure(spark):
    extra = [
        event(100, 1, 1, "203.0.113.9", "S", "2025-01-19 10:00:00"),
        event(101, 1, 1, "203.0.113.9", "F", "2025-01-19 11:00:00"),
        event(102, 1, 1, "203.0.113.9", "F", "2025-01-19 12:00:00"),
        event(103, 1, 1, "203.0.113.9", "F", "2025-01-19 13:00:00"),
        event(104, 1, 1, "203.0.113.9", "S", "2025-01-19 13:00:00"),
    ]
    wh = star(spark, extra)
    same = tuples(compromise.compromised_same_address(wh), "username")
    assert ("jsmith",) not in same
    anywhere = tuples(
        compromise.compromised_any_address(wh), "username", "source_ip", "failure_count"
    )
    assert sorted(row for row in anywhere if row[0] == "jsmith") == [
        ("jsmith", "10.0.1.25", 3), ("jsmith", "203.0.113.88", 3)
    ]


def test_host_without_criticality(spark):
    hosts = [*HOSTS, (10, "unrated-01", None, "Lab")]
    extra = [event(100, 1, 10, "203.0.113.9", "F", "2025-01-19 10:00:00")]
    wh = star(spark, extra, hosts=hosts)
    assert "unrated-01" not in [r[0] for r in tuples(assets.critical_asset_hunt(wh))]
    rules = dict(tuples(quality.constraint_violations(wh), "rule", "violations"))
    assert rules["asset_criticality allowed"] == 0


def test_missing_keys_are_violations(spark):
    wh = star(spark)
    nulled = warehouse.Warehouse(
        wh.users, wh.hosts.withColumn("host_id", F.expr("nullif(host_id, 3)")),
        wh.events.withColumn("event_id", F.expr("nullif(event_id, 5)")),
    )
    rules = {(t, r): n for t, r, n in tuples(quality.constraint_violations(nulled))}
    assert rules["dim_hosts", "host_id not null"] == 1
    assert rules["fact_auth_events", "event_id not null"] == 1


def test_accounts_without_a_department_are_compared_too(spark):
    users = [*USERS, (12, "nodept", None, False)]
    extra = [event(200 + h, 12, h, "10.0.0.7", "S", "2025-01-19 10:00:00") for h in range(1, 10)]
    extra += [event(220, 12, 10, "10.0.0.7", "S", "2025-01-19 10:00:00")]
    wh = star(spark, extra, users=users, hosts=[*HOSTS, (10, "extra-01", "LOW", "Lab")])
    compared = {r["username"]: r for r in risk_profiles.peer_comparison(wh).collect()}
    assert compared["nodept"]["department_mean"] == 10.0
    assert compared["nodept"]["unique_hosts_accessed"] == 10
    moved = tuples(risk_profiles.lateral_movement(wh, hosts=9), "username", "hosts_reached")
    assert ("nodept", 10) in moved


def test_user_without_events(spark):
    users = [*USERS, (12, "idle", "Sales", False)]
    wh = star(spark, users=users)
    assert "idle" not in [r[0] for r in tuples(accounts.account_activity(wh))]


def test_violations_are_counted(spark):
    users = [*USERS, (11, "svc-backup", "IT Ops", True)]
    hosts = [*HOSTS, (10, "odd", "SEVERE", None)]
    extra = [
        event(46, 1, 1, "10.0.0.1", "F", "2025-01-19 10:00:00"),
        event(101, 77, 1, "nonsense", "F", "2025-01-19 10:00:00"),
        event(102, 77, 88, "::1", "F", "2025-01-19 10:00:00"),
        event(103, 1, None, "10.0.0.1", "F", "2025-01-19 10:00:00"),
    ]
    wh = star(spark, extra, users=users, hosts=hosts)
    found = {
        (table, rule): count
        for table, rule, count in tuples(quality.constraint_violations(wh)) if count
    }
    assert found == {
        ("dim_users", "user_id unique"): 1,
        ("dim_users", "username unique"): 1,
        ("dim_hosts", "asset_criticality allowed"): 1,
        ("fact_auth_events", "event_id unique"): 1,
        ("fact_auth_events", "source_ip well formed"): 1,
        ("fact_auth_events", "user_id references user_id"): 2,
        ("fact_auth_events", "dest_host_id references host_id"): 1,
    }
    orphans = sorted(tuples(quality.orphan_events(wh), "event_id", "missing"))
    assert orphans == [(101, "user"), (102, "host"), (102, "user")]
    assert tuples(quality.unreadable_addresses(wh), "event_id") == [(101,)]


def test_floor_is_inclusive(spark):
    rows = [
        event(n, 1, 1, "10.0.0.1", "F", when)
        for n, when in enumerate(
            ["2024-12-31 23:59:59", "2025-01-01 00:00:00", "2025-01-01 00:00:01"]
        )
    ]
    wh = star(spark, events=rows)
    assert tuples(brute_force.brute_force(wh, threshold=1), "failed_attempts") == [(2,)]
    assert tuples(brute_force.brute_force(wh, since=None), "failed_attempts") == [(3,)]


def test_no_events(spark):
    wh = star(spark, events=[])
    for job in (
        brute_force.brute_force, brute_force.password_spraying,
        compromise.compromised_same_address, compromise.compromised_any_address,
        assets.critical_asset_attacks, assets.critical_asset_summary, accounts.privileged_audit,
        accounts.account_activity, accounts.event_timeline, external.external_ip_summary,
        external.threat_actors, temporal.attacks_by_hour, temporal.business_hours_comparison,
        temporal.high_risk_period_attacks, temporal.spray_by_hour,
    ):
        assert job(wh).count() == 0, job.__name__


def test_ties_are_ordered_by_name(spark):
    rows = [
        event(n, user, 1, address, "F", "2025-01-20 10:00:00")
        for n, (user, address) in enumerate(
            [(u, a) for u in (2, 1) for a in ("10.0.0.2", "10.0.0.1") for _ in range(3)]
        )
    ]
    found = brute_force.brute_force(star(spark, events=rows))
    assert tuples(found, "username", "source_ip") == [
        ("dbaker", "10.0.0.1"), ("dbaker", "10.0.0.2"),
        ("jsmith", "10.0.0.1"), ("jsmith", "10.0.0.2"),
    ]


def test_events_frame_has_the_declared_types(spark, sample):
    types = dict(sample.events.dtypes)
    assert types["event_timestamp"] == "timestamp_ntz"
    assert types["source_ip_num"] == "bigint"
    assert frame_of_events(spark, []).count() == 0
