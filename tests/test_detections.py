"""Known results of the detections on the 46-event star."""

from tests.sample_star import at, tuples

from gatewarden.operators import accounts, assets, brute_force, compromise, external
from gatewarden.plans import hunts

SPRAYED = ("dbaker", "jsmith", "kwilson", "lbrown", "mjones", "rjohnson", "schen", "tgarcia")


def groups_of(frame, *columns):
    """The groups of a long form, in order, once each."""
    return list(dict.fromkeys(tuples(frame, *columns)))


def test_brute_force(sample):
    assert tuples(brute_force.brute_force(sample)) == [
        ("admin", "IT Security", True, 4, "185.220.101.47", at(20, "14:30:00"), at(20, "14:30:45")),
        ("dbaker", "Engineering", False, 3, "10.0.3.78", at(20, "16:30:00"), at(20, "16:32:00")),
    ]


def test_password_spraying(sample):
    assert tuples(brute_force.password_spraying(sample)) == [
        ("198.51.100.42", 8, 8, at(19, "03:45:10"), at(19, "03:46:55"), name) for name in SPRAYED
    ]


def test_compromises_agree_on_the_sample(sample):
    expected = [
        ("dbaker", "Engineering", False, 3, at(20, "16:32:00"), at(20, "16:35:00"),
         "10.0.3.78", "laptop-dbaker", "LOW"),
        ("admin", "IT Security", True, 4, at(20, "14:30:45"), at(20, "14:31:00"),
         "185.220.101.47", "webserver-prod-01", "HIGH"),
    ]
    assert tuples(compromise.compromised_same_address(sample)) == expected
    anywhere = compromise.compromised_any_address(sample)
    assert tuples(anywhere, *compromise.COLUMNS) == expected
    assert tuples(anywhere, "failing_addresses") == [(1,), (1,)]


def test_critical_asset_attacks(sample):
    columns = ("hostname", "username", "attack_count", "unique_attackers")
    found = assets.critical_asset_attacks(sample)
    rows = groups_of(found, *columns)
    assert len(rows) == 13
    assert sum(row[3] for row in rows) == len(tuples(found)) == found.distinct().count()
    assert rows[:2] == [
        ("database-prod-01", "mjones", 2, 2),
        ("dc-corp-01", "dbaker", 2, 1),
    ]
    assert rows[8:11] == [
        ("webserver-prod-01", "admin", 4, 1),
        ("vpn-gateway", "kwilson", 2, 2),
        ("vpn-gateway", "lbrown", 2, 2),
    ]
    by_text = groups_of(
        assets.critical_asset_attacks_by_text(sample), "asset_criticality", "hostname", "username"
    )
    assert [row[0] for row in by_text] == ["HIGH"] * 5 + ["CRITICAL"] * 8


def test_critical_asset_summary(sample):
    columns = ("hostname", "total_attacks", "users_targeted", "unique_attackers")
    expected = [
        ("dc-corp-01", 6, 5, 2),
        ("database-prod-01", 4, 3, 3),
        ("webserver-prod-01", 6, 3, 3),
        ("vpn-gateway", 4, 2, 4),
    ]
    summary = assets.critical_asset_summary(sample)
    assert groups_of(summary, *columns) == expected
    assert summary.count() == sum(row[3] for row in expected)
    hunted = groups_of(
        assets.critical_asset_hunt(sample), "hostname", "attack_count", "unique_attackers"
    )
    shown = tuples(
        assets.critical_assets_dashboard(sample), "hostname", "attack_count", "unique_attackers"
    )
    assert hunted == shown
    assert sorted(hunted) == sorted((host, n, ips) for host, n, _, ips in expected)


def test_privileged_audit(sample):
    rows = tuples(
        accounts.privileged_audit(sample), "username", "success", "event_timestamp"
    )
    assert len(rows) == 16
    assert rows[0] == ("admin", True, at(20, "14:31:00"))
    assert rows[-1] == ("svc-backup", True, at(18, "02:00:00"))


def test_external_summary(sample):
    rows = tuples(
        external.external_ip_summary(sample),
        "source_ip", "total_attempts", "failed_attempts", "successful_logins",
        "unique_users_targeted", "unique_hosts_targeted",
    )
    assert rows == [
        ("203.0.113.88", 2, 0, 2, 2, 2),
        ("67.180.93.22", 2, 0, 2, 2, 2),
        ("185.220.101.47", 5, 4, 1, 1, 1),
        ("103.28.48.12", 1, 0, 1, 1, 1),
        ("73.241.12.56", 1, 0, 1, 1, 1),
        ("198.51.100.42", 8, 8, 0, 8, 4),
        ("45.142.212.61", 1, 1, 0, 1, 1),
    ]


def test_threat_actor_severity(sample):
    rows = dict(tuples(external.threat_actors(sample), "ip_address", "severity"))
    assert rows == {
        "185.220.101.47": "Critical",
        "198.51.100.42": "High",
        "203.0.113.88": "Medium",
        "67.180.93.22": "Medium",
        "103.28.48.12": "Medium",
        "73.241.12.56": "Medium",
        "45.142.212.61": "Low",
    }


def test_account_activity(sample):
    rows = tuples(
        accounts.account_activity(sample),
        "username", "total_events", "successful_logins", "failed_logins",
        "unique_source_ips", "unique_hosts_accessed",
    )
    assert rows == [
        ("svc-backup", 9, 9, 0, 1, 2),
        ("kwilson", 6, 3, 3, 2, 5),
        ("lbrown", 6, 3, 3, 6, 4),
        ("admin", 5, 1, 4, 1, 1),
        ("dbaker", 5, 1, 4, 2, 4),
        ("jsmith", 4, 2, 2, 3, 2),
        ("mjones", 4, 2, 2, 3, 1),
        ("jdoe-admin", 2, 2, 0, 1, 1),
        ("schen", 2, 1, 1, 2, 2),
        ("tgarcia", 2, 1, 1, 2, 1),
        ("rjohnson", 1, 0, 1, 1, 1),
    ]


def test_event_timeline(sample):
    rows = tuples(accounts.event_timeline(sample), "event_timestamp", "result")
    assert len(rows) == 46
    assert rows == sorted(rows, key=lambda row: row[0])
    assert [result for _, result in rows].count("Failed") == 21


class TestHunts:
    """Look-backs end at a given moment, are exclusive, and have no upper bound."""

    def test_brute_force(self, sample):
        found = hunts.hunt_brute_force(sample, "2025-01-21 15:00:00")
        assert tuples(found, "username") == [("dbaker",)]
        found = hunts.hunt_brute_force(sample, "2025-01-21 14:30:00")
        assert tuples(found, "username", "failed_attempts") == [("admin", 3), ("dbaker", 3)]
        found = hunts.hunt_brute_force(sample, "2025-01-21", username="admin", days=7)
        assert tuples(found, "username", "failed_attempts") == [("admin", 4)]
        assert hunts.exit_status(found) == 1
        nothing = hunts.hunt_brute_force(sample, "2025-03-01")
        assert hunts.exit_status(nothing) == 0

    def test_password_spraying(self, sample):
        found = hunts.hunt_password_spraying(sample, "2025-01-20")
        assert tuples(found, "source_ip", "users_targeted") == [("198.51.100.42", 8)] * 8
        other = hunts.hunt_password_spraying(
            sample, "2025-01-21", ip_address="10.0.3.78", threshold=1, days=7
        )
        assert tuples(other, "source_ip", "targeted_account") == [("10.0.3.78", "dbaker")]

    def test_compromises_limit_only_the_failures(self, sample):
        found = hunts.hunt_compromises(sample, "2025-01-25")
        assert tuples(found, "username") == [("dbaker",), ("admin",)]
        found = hunts.hunt_compromises(sample, "2025-01-27 16:29:00")
        assert tuples(found, "username") == [("dbaker",)]
        assert tuples(hunts.hunt_compromises(sample, "2025-02-25")) == []

    def test_external_threats(self, sample):
        found = hunts.hunt_external_threats(sample, "2025-01-25", min_attempts=2)
        assert tuples(found, "source_ip", "total_attempts", "unique_users_targeted") == [
            ("203.0.113.88", 2, 2),
            ("67.180.93.22", 2, 2),
            ("185.220.101.47", 5, 1),
            ("198.51.100.42", 8, 8),
        ]

    def test_privileged_activity(self, sample):
        found = hunts.hunt_privileged_activity(sample, "2025-01-21 12:00:00")
        assert tuples(found, "username") == [("admin",)] * 5
        found = hunts.hunt_privileged_activity(
            sample, "2025-01-21", username="svc-backup", hours=48
        )
        assert len(tuples(found)) == 6

    def test_critical_assets(self, sample):
        found = hunts.hunt_critical_assets(sample, "2025-01-27")
        assert groups_of(found, "hostname", "attack_count") == [
            ("webserver-prod-01", 4), ("database-prod-01", 2), ("dc-corp-01", 2),
            ("vpn-gateway", 1),
        ]
