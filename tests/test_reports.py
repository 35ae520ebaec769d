"""Scenario classes, headline counts, the executive report and the dashboard document."""

import json

from gatewarden.operators import scenarios
from gatewarden.plans import dashboard, executive, executive_texts
from tests.sample_star import event, star, tuples

SPRAYED = ("dbaker", "jsmith", "kwilson", "lbrown", "mjones", "rjohnson", "schen", "tgarcia")
SCENARIOS = [
    ("Normal Activity", 14, 5, 9), ("Other", 10, 4, 6), ("Service Account", 9, 0, 9),
    ("Password Spraying", 8, 8, 0), ("Brute Force", 5, 4, 1),
]

OVERALL, INCIDENTS, TOP, TIMELINE, ACTORS, ADVICE = executive_texts.CATEGORIES
EXECUTIVE = [
    (OVERALL, "External Attack Sources", "7 source(s)", "Non-internal IPs", "🔴"),
    (OVERALL, "Failed Login Attempts", "21 attempt(s)", "45.7%", "⚠️"),
    (OVERALL, "Privileged Accounts Active", "3 account(s)", "admin", "🔐"),
    (OVERALL, "Privileged Accounts Active", "3 account(s)", "jdoe-admin", "🔐"),
    (OVERALL, "Privileged Accounts Active", "3 account(s)", "svc-backup", "🔐"),
    (OVERALL, "Successful Logins", "25 login(s)", "54.3%", "✅"),
    (OVERALL, "Total Security Events", "46 event(s)", "", ""),
    (INCIDENTS, "Attacks on CRITICAL Assets", "10 attack(s)", "2 servers targeted", "🔴"),
    (INCIDENTS, "Password Spraying Attacks Detected", "1 attack(s)", "198.51.100.42 (8 users)",
     "🔴"),
    (INCIDENTS, "Successful Brute", "2 brute(s)", "admin from 185.220.101.47", "🔴"),
    (INCIDENTS, "Successful Brute", "2 brute(s)", "dbaker from 10.0.3.78", "🔴"),
    (TOP, "Most Attacked Server: dc-corp-01", "6 attack(s)", "CRITICAL criticality", "🔴"),
    (TOP, "Most Attacked User: admin", "4 attack(s)", "IT Security (PRIVILEGED)", "🔴"),
    (TOP, "Most Dangerous IP: 203.0.113.88", "2 attack(s) (2 succeeded)", "2 user(s) targeted",
     "🔴"),
    (TIMELINE, "First Attack Recorded", "2025-01-18 22:15", "Monitoring since", "📍"),
    (TIMELINE, "Most Recent Attack", "2025-01-20 17:30", "Last failed login", "📍"),
    (TIMELINE, "Peak Attack Day", "2025-01-20", "10 attack(s)", "📊"),
    (ACTORS, "103.28.48.12", "1 attempt(s)", "lbrown", "🟡 Successful External Login"),
    (ACTORS, "185.220.101.47", "5 attempt(s)", "admin", "🔴 Successful Brute Force"),
    *[(ACTORS, "198.51.100.42", "8 attempt(s)", name, "🔴 Password Spraying") for name in SPRAYED],
    (ACTORS, "203.0.113.88", "2 attempt(s)", "jsmith", "🟡 Successful External Login"),
    (ACTORS, "203.0.113.88", "2 attempt(s)", "lbrown", "🟡 Successful External Login"),
    (ACTORS, "45.142.212.61", "1 attempt(s)", "lbrown", "🟢 Blocked"),
    (ACTORS, "67.180.93.22", "2 attempt(s)", "lbrown", "🟡 Successful External Login"),
    (ACTORS, "67.180.93.22", "2 attempt(s)", "mjones", "🟡 Successful External Login"),
    (ACTORS, "73.241.12.56", "1 attempt(s)", "tgarcia", "🟡 Successful External Login"),
    (ADVICE, "IPs to Block", "3 IP(s)", "External IPs with failed attacks", "🟠"),
    (ADVICE, "Immediate Actions Required", "2 action(s)",
     "Compromised accounts needing password reset", "🔴"),
    (ADVICE, "Users Requiring Training", "4 user(s)", "Users with suspicious activity patterns",
     "🟡"),
]


def test_scenarios(sample):
    assert tuples(scenarios.scenario_classification(sample)) == SCENARIOS


def test_scenario_counts_add_up_to_all_events(sample):
    rows = tuples(scenarios.scenario_classification(sample))
    assert sum(row[1] for row in rows) == 46
    assert all(row[2] + row[3] == row[1] for row in rows)


def test_scenario_sets_ignore_the_floor(spark):
    """Old failures still mark an address as spraying and a user as attacked."""
    old = [event(n, n, 1, "203.0.113.5", "F", "2024-06-01 10:00:00") for n in range(1, 6)]
    old += [event(10 + n, 6, 1, "203.0.113.6", "F", "2024-06-01 10:00:00") for n in range(3)]
    new = [
        event(20, 7, 1, "203.0.113.5", "S", "2025-01-20 10:00:00"),
        event(21, 6, 1, "203.0.113.7", "S", "2025-01-20 10:00:00"),
        event(22, 6, 1, "10.0.0.7", "S", "2025-01-20 18:30:00"),
        event(23, 6, 1, "10.0.0.7", "S", "2025-01-20 19:00:00"),
    ]
    wh = star(spark, events=old + new)
    assert tuples(scenarios.scenario_classification(wh)) == [
        ("Brute Force", 1, 0, 1), ("Normal Activity", 1, 0, 1), ("Other", 1, 0, 1),
        ("Password Spraying", 1, 0, 1),
    ]


def test_kpis(sample):
    assert tuples(scenarios.kpi_summary(sample)) == [(46, 21, 25, 7)]


def test_kpis_without_events(spark):
    assert tuples(scenarios.kpi_summary(star(spark, events=[]))) == [(0, 0, 0, 0)]


def test_executive_report(sample):
    assert tuples(executive.executive_dashboard(sample)) == EXECUTIVE


def test_executive_report_without_events(spark):
    """Counting rows stay, with NULL lists; rows about a top subject disappear."""
    rows = tuples(executive.executive_dashboard(star(spark, events=[])))
    assert [(row[1], row[2]) for row in rows] == [
        ("External Attack Sources", "0 source(s)"),
        ("Failed Login Attempts", "0 attempt(s)"),
        ("Privileged Accounts Active", "0 account(s)"),
        ("Successful Logins", "0 login(s)"),
        ("Total Security Events", "0 event(s)"),
        ("Attacks on CRITICAL Assets", "0 attack(s)"),
        ("Password Spraying Attacks Detected", "0 attack(s)"),
        ("Successful Brute", "0 brute(s)"),
        ("First Attack Recorded", None),
        ("Most Recent Attack", None),
        ("IPs to Block", "0 IP(s)"),
        ("Immediate Actions Required", "0 action(s)"),
        ("Users Requiring Training", "0 user(s)"),
    ]
    details = {row[1]: row[3] for row in rows}
    assert details["Successful Brute"] is None
    assert details["Privileged Accounts Active"] is None
    assert details["Failed Login Attempts"] is None


def test_immediate_actions_ignore_the_floor_and_time_order(spark):
    """The success may come before the failures, and both before the floor."""
    rows = [event(1, 1, 1, "10.0.0.9", "S", "2024-01-01 00:00:00")]
    rows += [event(2 + n, 1, 1, "10.0.0.9", "F", "2024-01-02 00:00:00") for n in range(3)]
    values = dict(
        tuples(executive.executive_dashboard(star(spark, events=rows)), "metric", "value")
    )
    assert values["Immediate Actions Required"] == "1 action(s)"
    assert values["Successful Brute"] == "0 brute(s)"
    assert values["Users Requiring Training"] == "0 user(s)"


def document(frame) -> dict:
    lines = [row["line"] for row in frame.collect()]
    return json.loads("\n".join(lines))


def test_dashboard_document(sample):
    content = document(dashboard.dashboard_document(sample, "2025-01-21T00:00:00"))
    assert list(content) == [
        "generated_at", "summary", "scenarios", "threat_actors", "critical_assets"
    ]
    assert content["generated_at"] == "2025-01-21T00:00:00"
    assert content["summary"] == {
        "total_events": 46, "failed_logins": 21, "successful_logins": 25, "external_threats": 7
    }
    assert [tuple(row.values()) for row in content["scenarios"]] == SCENARIOS
    actors = content["threat_actors"]
    assert list(dict.fromkeys(row["ip_address"] for row in actors)) == [
        "203.0.113.88", "67.180.93.22", "185.220.101.47", "103.28.48.12", "73.241.12.56",
        "198.51.100.42", "45.142.212.61",
    ]
    assert [row for row in actors if row["ip_address"] == "185.220.101.47"] == [{
        "ip_address": "185.220.101.47", "total_attempts": 5, "successful": 1, "failed": 4,
        "users_targeted": 1, "username": "admin", "severity": "Critical",
    }]
    sprayed = [row["username"] for row in actors if row["ip_address"] == "198.51.100.42"]
    assert tuple(sprayed) == SPRAYED
    assert [tuple(row.values()) for row in content["critical_assets"]] == [
        ("dc-corp-01", "CRITICAL", 6, 2), ("webserver-prod-01", "HIGH", 6, 3),
        ("database-prod-01", "CRITICAL", 4, 3), ("vpn-gateway", "HIGH", 4, 4),
    ]


def test_temporal_document(sample):
    content = document(dashboard.dashboard_document(sample, "now", temporal=True))
    temporal = content["temporal_analysis"]
    assert list(temporal) == ["hourly_attacks", "business_hours", "day_of_week"]
    assert [row["hour"] for row in temporal["hourly_attacks"]] == [2, 3, 14, 16, 17, 22]
    assert [row["period"] for row in temporal["business_hours"]] == [
        "Business Hours", "Off-Hours"
    ]
    assert [row["day_name"] for row in temporal["day_of_week"]] == [
        "Sunday", "Monday", "Saturday"
    ]


class Scans:
    """Counts the runs over a star's events: each run of a job reads a counted column."""

    def __init__(self, wh):
        self.seen = wh.spark.sparkContext.accumulator(0)
        self.rows = wh.events.count()
        seen = self.seen

        def counted(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        self.wh = wh.with_events(wh.events.mapInArrow(counted, wh.events.schema))

    @property
    def passes(self) -> float:
        return self.seen.value / self.rows


def test_reports_read_the_events_few_times(sample):
    scans = Scans(sample)
    executive.executive_dashboard(scans.wh).collect()
    assert scans.passes == 2
    scans = Scans(sample)
    dashboard.dashboard_document(scans.wh, "now", temporal=True).collect()
    assert scans.passes == 3


def test_document_without_events(spark):
    content = document(dashboard.dashboard_document(star(spark, events=[]), "now", temporal=True))
    assert content["summary"]["total_events"] == 0
    assert content["scenarios"] == content["threat_actors"] == []
    assert content["temporal_analysis"]["hourly_attacks"] == []
