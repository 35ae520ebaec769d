"""DuckDB SQL for the registered queries, written independently of the jobs.

Every statement starts from the same five star tables derived from the trial
tables, and uses window frames, FILTER clauses and distinct aggregates where
the jobs pre-aggregate.
"""

from __future__ import annotations

STAR = """
raw_events AS (
  SELECT event_id, user_id, ts, event_type AS kind,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events
),
fact AS (
  SELECT event_id, user_id,
         CASE WHEN k % 11 <> 0 THEN CAST(k % 13 AS BIGINT) END AS dest_host_id,
         CASE WHEN k < 45 THEN format('10.{}.0.{}', k % 3, user_id % 250)
              WHEN k < 53 THEN format('172.{}.0.{}', k % 3 + 16, user_id % 250)
              WHEN k < 60 THEN format('192.168.{}.{}', k % 3, user_id % 250)
              ELSE format('198.51.{}.{}', user_id % 5, k) END AS source_ip,
         CASE kind WHEN 'error' THEN 'failed_login' WHEN 'view' THEN 'logout'
                   ELSE 'login' END AS event_type,
         kind <> 'error' AS success,
         ts AS event_timestamp
  FROM raw_events
),
facts AS (
  SELECT *, CAST(split_part(source_ip, '.', 1) AS INTEGER) <> 10 AS is_external,
         date_trunc('hour', event_timestamp) AS hour_start
  FROM fact
),
recent AS (SELECT * FROM facts WHERE event_timestamp >= TIMESTAMP '2024-01-08'),
users AS (
  SELECT c_custkey AS user_id, c_name AS username,
         CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS department,
         c_custkey % 8 = 0 AS is_privileged
  FROM customer
),
hosts AS (
  SELECT s_suppkey AS host_id, s_name AS hostname, n_name AS location,
         ['CRITICAL', 'HIGH', 'MEDIUM', 'LOW'][(s_suppkey % 4) + 1] AS asset_criticality
  FROM supplier JOIN nation ON n_nationkey = s_nationkey
),
hours AS (
  SELECT h AS full_timestamp, CAST(h AS DATE) AS date,
         CAST(year(h) AS INTEGER) AS year, CAST(quarter(h) AS INTEGER) AS quarter,
         CAST(month(h) AS INTEGER) AS month, monthname(h) AS month_name,
         CAST(weekofyear(h) AS INTEGER) AS week_of_year,
         CAST(day(h) AS INTEGER) AS day_of_month,
         CAST(dayofweek(h) AS INTEGER) AS day_of_week, dayname(h) AS day_name,
         CAST(hour(h) AS INTEGER) AS hour, CAST(0 AS INTEGER) AS minute,
         dayofweek(h) IN (0, 6) AS is_weekend,
         dayofweek(h) NOT IN (0, 6) AND hour(h) >= 8 AND hour(h) <= 17 AS is_business_hours,
         hour(h) >= 22 OR hour(h) < 6 AS is_night_shift,
         CASE WHEN dayofweek(h) IN (0, 6) OR hour(h) >= 22 OR hour(h) < 6 THEN 'HIGH_RISK'
              WHEN hour(h) IN (6, 7) OR hour(h) BETWEEN 18 AND 21 THEN 'MEDIUM_RISK'
              ELSE 'NORMAL' END AS risk_period
  FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00',
                                      TIMESTAMP '2024-12-31 23:00:00', INTERVAL 1 HOUR)) AS h)
)
"""


def _sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([STAR.strip(), *ctes]) + "\n" + body


def _tenths(part: str, total: str) -> str:
    """Exact percentage with one decimal, halves up."""
    return f"CAST(((2000 * ({part}) + ({total})) // (2 * ({total}))) AS DOUBLE) / 10"


def _brute(events: str, threshold: int = 3, extra: str = "") -> str:
    return _sql(f"""
SELECT username, department, is_privileged, count(*) AS failed_attempts, source_ip,
       min(event_timestamp) AS first_attempt, max(event_timestamp) AS last_attempt
FROM {events} JOIN users USING (user_id)
WHERE NOT success {extra}
GROUP BY ALL HAVING count(*) >= {threshold}
""")


def _spray(events: str, threshold: int = 5, extra: str = "") -> str:
    return _sql(f"""
SELECT sprayers.*, username AS targeted_account
FROM sprayers JOIN (SELECT DISTINCT source_ip, username FROM failed) USING (source_ip)
""", f"""
failed AS (SELECT * FROM {events} JOIN users USING (user_id) WHERE NOT success {extra}),
sprayers AS (
  SELECT source_ip, count(DISTINCT user_id) AS users_targeted, count(*) AS total_attempts,
         min(event_timestamp) AS attack_start, max(event_timestamp) AS attack_end
  FROM failed GROUP BY source_ip HAVING count(DISTINCT user_id) >= {threshold}
)""")


_STREAKS = """
streaks AS (
  SELECT user_id, source_ip, count(*) AS failure_count, max(event_timestamp) AS last_failure
  FROM facts WHERE NOT success {window}
  GROUP BY user_id, source_ip HAVING count(*) >= 3
)"""


def _compromise(failed_after: str | None, host_join: str) -> str:
    window = f"AND event_timestamp > TIMESTAMP '{failed_after}'" if failed_after else ""
    return _sql(f"""
SELECT username, department, is_privileged, failure_count, last_failure,
       s.event_timestamp AS successful_login_time, s.source_ip,
       hostname AS target_host, asset_criticality
FROM streaks f
JOIN facts s ON s.user_id = f.user_id AND s.source_ip = f.source_ip
            AND s.success AND s.event_timestamp > f.last_failure
JOIN users u ON u.user_id = s.user_id
{host_join} JOIN hosts h ON h.host_id = s.dest_host_id
""", _STREAKS.format(window=window))


_HIGH_VALUE = """
hits AS (
  SELECT * FROM {events} e JOIN hosts h ON h.host_id = e.dest_host_id
  WHERE NOT success AND asset_criticality IN ('CRITICAL', 'HIGH')
)"""


def _asset_attacks(count_name: str) -> str:
    return _sql("""
SELECT groups.*, source_ip AS attacker_ip
FROM groups JOIN (SELECT DISTINCT hostname, username, source_ip FROM known)
  USING (hostname, username)
""", _HIGH_VALUE.format(events="recent"), f"""
known AS (SELECT * FROM hits JOIN users USING (user_id)),
groups AS (
  SELECT hostname, asset_criticality, location, username, is_privileged,
         count(*) AS {count_name}, count(DISTINCT source_ip) AS unique_attackers
  FROM known GROUP BY hostname, asset_criticality, location, username, is_privileged
)""")


def _asset_hunt(events: str) -> str:
    return _sql("""
SELECT groups.*, source_ip AS attacker_ip
FROM groups JOIN (SELECT DISTINCT hostname, source_ip FROM hits) USING (hostname)
""", _HIGH_VALUE.format(events=events), """
groups AS (
  SELECT hostname, asset_criticality, location, count(*) AS attack_count,
         count(DISTINCT source_ip) AS unique_attackers
  FROM hits GROUP BY hostname, asset_criticality, location
)""")


def _audit(events: str, host_join: str, extra: str = "") -> str:
    return _sql(f"""
SELECT username, department, hostname, asset_criticality, event_type, success,
       event_timestamp, source_ip
FROM {events} e JOIN users u ON u.user_id = e.user_id AND u.is_privileged
{host_join} JOIN hosts h ON h.host_id = e.dest_host_id
WHERE true {extra}
""")


_NOT_PRIVATE = """AND NOT regexp_full_match(
  source_ip, '(172[.](1[6-9]|2[0-9]|3[01])|192[.]168)[.].*')"""


def _external(events: str, host_join: str, extra: str = "") -> str:
    return _sql(f"""
SELECT source_ip, count(*) AS total_attempts,
       count(*) FILTER (NOT success) AS failed_attempts,
       count(*) FILTER (success) AS successful_logins,
       count(DISTINCT user_id) AS unique_users_targeted,
       count(DISTINCT host_id) AS unique_hosts_targeted,
       min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen
FROM {events} e JOIN users USING (user_id)
{host_join} JOIN hosts h ON h.host_id = e.dest_host_id
WHERE is_external {extra} GROUP BY source_ip
""")


def _external_hunt(events: str, minimum: int) -> str:
    return _sql(f"""
SELECT source_ip, count(*) AS total_attempts,
       count(*) FILTER (NOT success) AS failed_attempts,
       count(*) FILTER (success) AS successful_logins,
       count(DISTINCT user_id) AS unique_users_targeted,
       min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen
FROM {events} JOIN users USING (user_id)
WHERE is_external GROUP BY source_ip HAVING count(*) >= {minimum}
""")


def _since(moment: str) -> str:
    return f"(SELECT * FROM facts WHERE event_timestamp > TIMESTAMP '{moment}')"


_TIMED = "recent JOIN hours ON full_timestamp = hour_start"

_ACTORS = """
actors AS (
  SELECT source_ip AS ip_address, count(*) AS total_attempts,
         count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS failed,
         count(DISTINCT user_id) AS users_targeted
  FROM recent JOIN users USING (user_id) WHERE is_external GROUP BY source_ip
),
rated AS (
  SELECT actors.*, username,
         CASE WHEN successful > 0 AND failed >= 3 THEN 'Critical'
              WHEN users_targeted >= 5 THEN 'High'
              WHEN successful > 0 THEN 'Medium' ELSE 'Low' END AS severity
  FROM actors
  JOIN (SELECT DISTINCT source_ip AS ip_address, username FROM recent JOIN users USING (user_id))
    USING (ip_address)
)"""

_SCENARIOS = """
sprayers AS (
  SELECT source_ip FROM facts WHERE NOT success
  GROUP BY source_ip HAVING count(DISTINCT user_id) >= 5
),
forced AS (
  SELECT DISTINCT user_id FROM (
    SELECT user_id FROM facts WHERE NOT success
    GROUP BY user_id, source_ip HAVING count(*) >= 3)
),
classed AS (
  SELECT success,
         CASE WHEN source_ip IN (FROM sprayers) THEN 'Password Spraying'
              WHEN is_external AND user_id IN (FROM forced) THEN 'Brute Force'
              WHEN user_id = 11 THEN 'Service Account'
              WHEN NOT is_external AND dayofweek(event_timestamp) NOT IN (0, 6)
                   AND hour(event_timestamp) BETWEEN 8 AND 18
              THEN 'Normal Activity' ELSE 'Other' END AS scenario
  FROM recent
),
scenarios AS (
  SELECT scenario, count(*) AS event_count, count(*) FILTER (NOT success) AS failed_count,
         count(*) FILTER (success) AS success_count
  FROM classed GROUP BY scenario
)"""

_KPI = """
kpi AS (
  SELECT count(*) AS total_events, count(*) FILTER (NOT success) AS failed_logins,
         count(*) FILTER (success) AS successful_logins,
         count(DISTINCT source_ip) FILTER (is_external) AS external_ips
  FROM recent
)"""

_DASHBOARD_ASSETS = """
asset_counts AS (
  SELECT hostname, asset_criticality, count(*) AS attack_count,
         count(DISTINCT source_ip) AS unique_attackers
  FROM hits GROUP BY hostname, asset_criticality
)"""

_HOURLY = f"""
hourly AS (
  SELECT hour, count(*) AS attack_count, is_business_hours, risk_period
  FROM {_TIMED} WHERE NOT success GROUP BY hour, is_business_hours, risk_period
)"""

_PERIODS = f"""
periods AS (
  SELECT if(is_business_hours, 'Business Hours', 'Off-Hours') AS period,
         count(*) AS total_attacks, count(DISTINCT source_ip) AS unique_attackers,
         count(*) FILTER (success) AS successful_attempts
  FROM {_TIMED} GROUP BY is_business_hours
)"""

_WEEKDAYS = f"""
weekdays AS (
  SELECT day_name, is_weekend, day_of_week, count(*) AS event_count,
         count(*) FILTER (NOT success) AS failed_attempts,
         count(*) FILTER (success) AS successful_logins
  FROM {_TIMED} GROUP BY day_name, is_weekend, day_of_week
)"""

_DETAIL = """
SELECT event_id, user_id, dest_host_id, source_ip, event_type, success, event_timestamp,
       username, department, is_privileged, full_timestamp, date, day_of_week, day_name,
       hour, is_weekend, is_business_hours, is_night_shift, risk_period
FROM facts JOIN users USING (user_id) JOIN hours ON full_timestamp = hour_start
"""


def _rank(number: str) -> str:
    return f"lpad(CAST({number} + 1000000000000000000 AS VARCHAR), 19, '0')"


_RECORDS = f"""
records AS (
  SELECT 0 AS section_no, 'summary' AS section, '' AS rank,
         CAST(to_json({{'total_events': total_events, 'failed_logins': failed_logins,
                  'successful_logins': successful_logins,
                  'external_threats': external_ips}}) AS VARCHAR) AS record FROM kpi
  UNION ALL
  SELECT 1, 'scenarios', {_rank("-event_count")} || '|' || scenario,
         CAST(to_json({{'scenario': scenario, 'event_count': event_count,
                  'failed_count': failed_count, 'success_count': success_count}}) AS VARCHAR)
  FROM scenarios
  UNION ALL
  SELECT 2, 'threat_actors',
         concat_ws('|', {_rank("-successful")}, {_rank("-total_attempts")}, ip_address, username),
         CAST(to_json({{'ip_address': ip_address, 'total_attempts': total_attempts,
                  'successful': successful, 'failed': failed,
                  'users_targeted': users_targeted, 'username': username,
                  'severity': severity}}) AS VARCHAR)
  FROM rated
  UNION ALL
  SELECT 3, 'critical_assets', {_rank("-attack_count")} || '|' || hostname,
         CAST(to_json({{'hostname': hostname, 'asset_criticality': asset_criticality,
                  'attack_count': attack_count, 'unique_attackers': unique_attackers}})
              AS VARCHAR)
  FROM asset_counts
)"""

_TEMPORAL_RECORDS = f"""
all_records AS (
  SELECT * FROM records
  UNION ALL
  SELECT 4, 'hourly_attacks',
         {_rank("hour")} || '|' || {_rank("CAST(is_business_hours AS BIGINT)")},
         CAST(to_json({{'hour': hour, 'attack_count': attack_count,
                  'is_business_hours': is_business_hours, 'risk_period': risk_period}})
              AS VARCHAR)
  FROM hourly
  UNION ALL
  SELECT 5, 'business_hours', period,
         CAST(to_json({{'period': period, 'total_attacks': total_attacks,
                  'unique_attackers': unique_attackers,
                  'successful_attempts': successful_attempts}}) AS VARCHAR)
  FROM periods
  UNION ALL
  SELECT 6, 'day_of_week', {_rank("day_of_week + 1")},
         CAST(to_json({{'day_name': day_name, 'is_weekend': is_weekend,
                  'event_count': event_count, 'failed_attempts': failed_attempts}}) AS VARCHAR)
  FROM weekdays
)"""

_MAIN_PARTS = (
    _KPI, _SCENARIOS, _ACTORS, _HIGH_VALUE.format(events="recent"), _DASHBOARD_ASSETS, _RECORDS,
)
_ALL_PARTS = (*_MAIN_PARTS, _HOURLY, _PERIODS, _WEEKDAYS, _TEMPORAL_RECORDS)

_OPENINGS = """
(0, 0, '{"generated_at": "2024-01-31T00:00:00", "summary": '), (0, 2, ','),
(1, 0, '"scenarios": ['), (1, 2, '],'),
(2, 0, '"threat_actors": ['), (2, 2, '],'),
(3, 0, '"critical_assets": ['), """

_TEMPORAL_OPENINGS = """(3, 2, '],'),
(4, 0, '"temporal_analysis": {"hourly_attacks": ['), (4, 2, '],'),
(5, 0, '"business_hours": ['), (5, 2, '],'),
(6, 0, '"day_of_week": ['), (6, 2, ']}}')"""


def _document(table: str, closings: str, *parts: str) -> str:
    return _sql(f"""
SELECT CAST(section_no AS INTEGER) AS section_no, CAST(1 AS INTEGER) AS place, rank,
       if(row_number() OVER (PARTITION BY section_no ORDER BY rank) = 1, '', ',') || record
         AS line
FROM {table}
UNION ALL
SELECT CAST(n AS INTEGER), CAST(p AS INTEGER), '', t
FROM (VALUES {_OPENINGS}{closings}) AS outline(n, p, t)
""", *parts)


_EXECUTIVE = _sql(f"""
SELECT '📊 OVERALL METRICS' AS category, 'Total Security Events' AS metric,
       total_events || ' event(s)' AS value, '' AS details, '' AS severity FROM kpi
UNION ALL
SELECT '📊 OVERALL METRICS', 'Failed Login Attempts', failed_logins || ' attempt(s)',
       printf('%.1f', {_tenths("failed_logins", "total_events")}) || '%',
       if(failed_logins > 10, '⚠️', '✅') FROM kpi
UNION ALL
SELECT '📊 OVERALL METRICS', 'Successful Logins', successful_logins || ' login(s)',
       printf('%.1f', {_tenths("successful_logins", "total_events")}) || '%', '✅' FROM kpi
UNION ALL
SELECT '📊 OVERALL METRICS', 'External Attack Sources', external_ips || ' source(s)',
       'Non-internal IPs', if(external_ips > 3, '🔴', '🟡') FROM kpi
UNION ALL
SELECT '📊 OVERALL METRICS', 'Privileged Accounts Active', n || ' account(s)', username, '🔐'
FROM (SELECT count(*) AS n FROM admins) LEFT JOIN admins ON TRUE
UNION ALL
SELECT '🚨 CRITICAL INCIDENTS', 'Successful Brute',
       n || ' brute(s)', username || ' from ' || source_ip, '🔴'
FROM (SELECT count(DISTINCT user_id) AS n FROM brutes) LEFT JOIN brutes ON TRUE
UNION ALL
SELECT '🚨 CRITICAL INCIDENTS', 'Password Spraying Attacks Detected',
       found || ' attack(s)', source_ip || ' (' || n || ' users)', '🔴'
FROM (SELECT count(*) AS found FROM sprays) LEFT JOIN sprays ON TRUE
UNION ALL
SELECT '🚨 CRITICAL INCIDENTS', 'Attacks on CRITICAL Assets', count(*) || ' attack(s)',
       count(DISTINCT hostname) || ' servers targeted', '🔴'
FROM hits WHERE asset_criticality = 'CRITICAL'
UNION ALL
(SELECT '🎯 TOP THREATS', 'Most Attacked User: ' || username, count(*) || ' attack(s)',
        department || if(is_privileged, ' (PRIVILEGED)', ''), if(is_privileged, '🔴', '🟡')
 FROM recent JOIN users USING (user_id) WHERE NOT success
 GROUP BY username, department, is_privileged ORDER BY count(*) DESC, username LIMIT 1)
UNION ALL
(SELECT '🎯 TOP THREATS', 'Most Attacked Server: ' || hostname, count(*) || ' attack(s)',
        asset_criticality || ' criticality',
        CASE asset_criticality WHEN 'CRITICAL' THEN '🔴' WHEN 'HIGH' THEN '🟠' ELSE '🟡' END
 FROM recent JOIN hosts ON host_id = dest_host_id WHERE NOT success
 GROUP BY hostname, asset_criticality ORDER BY count(*) DESC, hostname LIMIT 1)
UNION ALL
(SELECT '🎯 TOP THREATS', 'Most Dangerous IP: ' || ip_address,
        format('{{}} attack(s) ({{}} succeeded)', total_attempts, successful),
        users_targeted || ' user(s) targeted', '🔴'
 FROM actors ORDER BY successful DESC, total_attempts DESC, ip_address LIMIT 1)
UNION ALL
SELECT '📅 ATTACK TIMELINE', 'First Attack Recorded',
       strftime(min(event_timestamp), '%Y-%m-%d %H:%M'), 'Monitoring since', '📍'
FROM recent WHERE NOT success
UNION ALL
SELECT '📅 ATTACK TIMELINE', 'Most Recent Attack',
       strftime(max(event_timestamp), '%Y-%m-%d %H:%M'), 'Last failed login', '📍'
FROM recent WHERE NOT success
UNION ALL
(SELECT '📅 ATTACK TIMELINE', 'Peak Attack Day', strftime(event_timestamp, '%Y-%m-%d') AS day,
        count(*) || ' attack(s)', '📊'
 FROM recent WHERE NOT success GROUP BY day ORDER BY count(*) DESC, day LIMIT 1)
UNION ALL
SELECT '👤 THREAT ACTORS', ip_address, total_attempts || ' attempt(s)', username,
       CASE severity WHEN 'Critical' THEN '🔴 Successful Brute Force'
                     WHEN 'High' THEN '🔴 Password Spraying'
                     WHEN 'Medium' THEN '🟡 Successful External Login'
                     ELSE '🟢 Blocked' END
FROM rated
UNION ALL
SELECT '✅ RECOMMENDATIONS', 'Immediate Actions Required',
       count(DISTINCT user_id) || ' action(s)',
       'Compromised accounts needing password reset', '🔴'
FROM (SELECT user_id FROM facts GROUP BY user_id, source_ip
      HAVING count(*) FILTER (NOT success) >= 3 AND bool_or(success))
UNION ALL
SELECT '✅ RECOMMENDATIONS', 'IPs to Block', count(DISTINCT source_ip) || ' IP(s)',
       'External IPs with failed attacks', '🟠'
FROM recent WHERE is_external AND NOT success
UNION ALL
SELECT '✅ RECOMMENDATIONS', 'Users Requiring Training', count(*) || ' user(s)',
       'Users with suspicious activity patterns', '🟡'
FROM (SELECT user_id FROM recent WHERE NOT success GROUP BY user_id HAVING count(*) >= 3)
""", _KPI, _ACTORS, _HIGH_VALUE.format(events="recent"), """
brutes AS (
  SELECT user_id, username, source_ip FROM recent JOIN users USING (user_id)
  GROUP BY user_id, username, source_ip
  HAVING count(*) FILTER (NOT success) >= 3 AND bool_or(success)
),
admins AS (SELECT DISTINCT username FROM recent JOIN users USING (user_id) WHERE is_privileged),
sprays AS (
  SELECT source_ip, count(DISTINCT user_id) AS n FROM recent WHERE NOT success
  GROUP BY source_ip HAVING count(DISTINCT user_id) >= 5
)""")

_DAYS_WITH_EVENTS = """
span AS (SELECT CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) AS last FROM events),
covered AS (SELECT hours.* FROM hours, span WHERE date BETWEEN first AND last)"""


def _violation(table: str, rule: str, count: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, "
        f"CAST(({count}) AS BIGINT) AS violations"
    )


def _unique(table: str, source: str, key: str) -> str:
    return _violation(
        table, f"{key} unique", f"SELECT count({key}) - count(DISTINCT {key}) FROM {source}"
    )


def _broken(table: str, source: str, rule: str, condition: str) -> str:
    return _violation(table, rule, f"SELECT count(*) FROM {source} WHERE {condition}")


_VIOLATIONS = _sql("\nUNION ALL\n".join([
    _unique("dim_users", "users", "user_id"),
    _unique("dim_users", "users", "username"),
    _unique("dim_hosts", "hosts", "host_id"),
    _unique("dim_hosts", "hosts", "hostname"),
    _unique("fact_auth_events", "facts", "event_id"),
    _broken("dim_users", "users", "user_id not null", "user_id IS NULL"),
    _broken("dim_users", "users", "username not null", "username IS NULL"),
    _broken("dim_hosts", "hosts", "host_id not null", "host_id IS NULL"),
    _broken("dim_hosts", "hosts", "hostname not null", "hostname IS NULL"),
    _broken("dim_hosts", "hosts", "asset_criticality allowed",
            "asset_criticality NOT IN ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW')"),
    _broken("fact_auth_events", "facts", "event_id not null", "event_id IS NULL"),
    _broken("fact_auth_events", "facts", "user_id not null", "user_id IS NULL"),
    _broken("fact_auth_events", "facts", "source_ip not null", "source_ip IS NULL"),
    _broken("fact_auth_events", "facts", "source_ip well formed",
            "NOT regexp_full_match(source_ip, '([0-9]{1,3}[.]){3}[0-9]{1,3}')"),
    _broken("fact_auth_events", "facts", "success not null", "success IS NULL"),
    _broken("fact_auth_events", "facts", "event_timestamp not null", "event_timestamp IS NULL"),
    _broken("fact_auth_events", "facts", "user_id references user_id",
            "user_id NOT IN (SELECT user_id FROM users)"),
    _broken("fact_auth_events", "facts", "dest_host_id references host_id",
            "dest_host_id NOT IN (SELECT host_id FROM hosts)"),
]))

_ADDRESS_TEXTS = """
texts AS (
  SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '300.1.2.3'
                        WHEN event_id % 11 = 0 THEN '2001:db8::1' ELSE source_ip END AS source_ip
  FROM facts
)"""

ORACLE: dict[str, str] = {
    "brute_force": _brute("recent"),
    "password_spraying": _spray("recent"),
    "compromise_same_ip": _compromise(None, "INNER"),
    "compromise_same_ip_left": _compromise("2024-01-17", "LEFT"),
    "compromise_any_ip": _sql("""
SELECT username, department, is_privileged,
       CAST(sum(failure_count) AS BIGINT) AS failure_count, max(f.last_failure) AS last_failure,
       s.event_timestamp AS successful_login_time, s.source_ip, hostname AS target_host,
       asset_criticality, count(*) AS failing_addresses
FROM streaks f
JOIN facts s ON s.user_id = f.user_id AND s.success AND s.event_timestamp > f.last_failure
JOIN users u ON u.user_id = s.user_id
JOIN hosts h ON h.host_id = s.dest_host_id
GROUP BY s.event_id, username, department, is_privileged, s.event_timestamp, s.source_ip,
         hostname, asset_criticality
""", _STREAKS.format(window="")),
    "critical_asset_attacks": _asset_attacks("attack_count"),
    "critical_asset_attacks_by_text": _asset_attacks("attack_attempts"),
    "critical_asset_summary": _sql("""
SELECT groups.*, source_ip AS attacker_ip
FROM groups JOIN (SELECT DISTINCT hostname, source_ip FROM known) USING (hostname)
""", _HIGH_VALUE.format(events="recent"), """
known AS (SELECT * FROM hits JOIN users USING (user_id)),
groups AS (
  SELECT hostname, asset_criticality, count(*) AS total_attacks,
         count(DISTINCT user_id) AS users_targeted, count(DISTINCT source_ip) AS unique_attackers
  FROM known GROUP BY hostname, asset_criticality
)"""),
    "critical_asset_hunt": _asset_hunt("recent"),
    "critical_assets_dashboard": _sql(
        "SELECT * FROM asset_counts", _HIGH_VALUE.format(events="recent"), _DASHBOARD_ASSETS
    ),
    "privileged_audit": _audit("recent", "LEFT"),
    "privileged_audit_inner": _audit("recent", "INNER"),
    "external_ip_summary": _external("recent", "LEFT"),
    "external_ip_summary_inner": _external("recent", "INNER"),
    "external_threats_hunt": _external_hunt("recent", 10),
    "threat_actors": _sql("SELECT * FROM rated", _ACTORS),
    "account_activity": _sql("""
SELECT username, department, is_privileged, count(*) AS total_events,
       count(*) FILTER (success) AS successful_logins,
       count(*) FILTER (NOT success) AS failed_logins,
       count(DISTINCT source_ip) AS unique_source_ips,
       count(DISTINCT host_id) AS unique_hosts_accessed,
       min(event_timestamp) AS first_activity, max(event_timestamp) AS last_activity
FROM recent e JOIN users USING (user_id) LEFT JOIN hosts ON host_id = e.dest_host_id
GROUP BY username, department, is_privileged
"""),
    "attacks_by_hour": _sql(f"""
SELECT hour, attack_count, is_business_hours, risk_period,
       {_tenths("attack_count", "(SELECT CAST(sum(attack_count) AS BIGINT) FROM hourly)")}
         AS percent_of_total
FROM hourly
""", _HOURLY),
    "hourly_attacks_dashboard": _sql("SELECT * FROM hourly", _HOURLY),
    "business_hours_comparison": _sql(f"""
SELECT is_business_hours, count(*) AS total_attacks,
       count(DISTINCT source_ip) AS unique_attackers,
       count(DISTINCT user_id) AS unique_targets,
       {_tenths("count(*) FILTER (success)", "count(*)")} AS success_rate_percent
FROM {_TIMED} GROUP BY is_business_hours
"""),
    "business_hours_dashboard": _sql("SELECT * FROM periods", _PERIODS),
    "day_of_week_pattern": _sql("SELECT * EXCLUDE day_of_week FROM weekdays", _WEEKDAYS),
    "day_of_week_dashboard": _sql(
        "SELECT * EXCLUDE (day_of_week, successful_logins) FROM weekdays", _WEEKDAYS
    ),
    "high_risk_period_attacks": _sql(f"""
SELECT source_ip, username, risk_period, count(*) AS attack_count,
       string_agg(DISTINCT strftime(event_timestamp, '%b %d %H:%M'), ', '
                  ORDER BY strftime(event_timestamp, '%b %d %H:%M')) AS attack_times
FROM {_TIMED} JOIN users USING (user_id)
WHERE NOT success AND risk_period = 'HIGH_RISK'
GROUP BY source_ip, username, risk_period
"""),
    "night_shift_anomalies": _sql(f"""
SELECT username, department, is_privileged, count(*) AS night_logins,
       min(event_timestamp) AS first_night_login, max(event_timestamp) AS last_night_login
FROM {_TIMED} JOIN users USING (user_id)
WHERE success AND is_night_shift AND department NOT IN ('MACHINERY', 'HOUSEHOLD')
GROUP BY username, department, is_privileged
"""),
    "hourly_heatmap": _sql(f"""
SELECT day_name, hour, count(*) AS attack_count,
       CASE WHEN count(*) >= 5 THEN 'CRITICAL' WHEN count(*) >= 3 THEN 'HIGH'
            ELSE 'MEDIUM' END AS severity
FROM {_TIMED} WHERE NOT success GROUP BY day_name, hour
"""),
    "privileged_off_hours": _sql(f"""
SELECT username, department, hostname, event_timestamp, day_name, hour, risk_period,
       source_ip, success
FROM {_TIMED} JOIN users u USING (user_id) LEFT JOIN hosts ON host_id = recent.dest_host_id
WHERE is_privileged AND NOT is_business_hours
"""),
    "privileged_off_hours_detail": _sql(_DETAIL + "WHERE is_privileged AND NOT is_business_hours"),
    "spray_by_hour": _sql("""
SELECT hour, count(*) AS attack_count, count(DISTINCT user_id) AS users_targeted
FROM facts JOIN hours ON full_timestamp = hour_start
WHERE NOT success GROUP BY hour HAVING count(DISTINCT user_id) >= 68
"""),
    "department_night_logins": _sql(
        _DETAIL + "WHERE department = 'BUILDING' AND is_night_shift AND success"
    ),
    "scenario_classification": _sql("SELECT * FROM scenarios", _SCENARIOS),
    "kpi_summary": _sql("SELECT * FROM kpi", _KPI),
    "event_timeline": _sql("""
SELECT event_timestamp, CAST(event_timestamp AS DATE) AS date, source_ip, user_id, success,
       if(success, 'Success', 'Failed') AS result
FROM recent
"""),
    "executive_dashboard": _EXECUTIVE,
    "soc_dashboard_records": _sql("SELECT section, rank, record FROM all_records", *_ALL_PARTS),
    "soc_dashboard_document": _document("records", "(3, 2, ']}')", *_MAIN_PARTS),
    "soc_dashboard_temporal_document": _document("all_records", _TEMPORAL_OPENINGS, *_ALL_PARTS),
    "hunt_brute_force": _brute(_since("2024-01-21")),
    "hunt_brute_force_user": _brute(
        _since("2024-01-01"), 2, "AND username = 'Customer#000000021'"
    ),
    "hunt_password_spraying": _spray(_since("2024-01-17")),
    "hunt_password_spraying_ip": _spray(
        _since("2024-01-01"), 3, "AND source_ip = '198.51.1.66'"
    ),
    "hunt_compromises": _compromise("2024-01-10", "LEFT"),
    "hunt_external_threats": _external_hunt(_since("2024-01-24"), 5),
    "hunt_privileged_activity": _audit("facts", "LEFT",
                                       "AND event_timestamp > TIMESTAMP '2024-01-28'"),
    "hunt_privileged_activity_user": _audit(
        "facts", "LEFT",
        "AND event_timestamp > TIMESTAMP '2024-01-21' AND username = 'Customer#000000008'",
    ),
    "hunt_critical_assets": _asset_hunt(_since("2024-01-24")),
    "calendar": _sql("""
SELECT *, CAST(date_diff('hour', TIMESTAMP '2024-01-01', full_timestamp) + 1 AS INTEGER)
            AS time_id
FROM covered
""", _DAYS_WITH_EVENTS),
    "calendar_span": _sql("""
SELECT count(*) AS total_hours, min(full_timestamp) AS earliest, max(full_timestamp) AS latest
FROM covered
""", _DAYS_WITH_EVENTS),
    "calendar_day": _sql("""
SELECT full_timestamp, day_name, hour, is_weekend, is_business_hours, is_night_shift,
       risk_period
FROM covered WHERE date = DATE '2024-01-20' ORDER BY hour LIMIT 10
""", _DAYS_WITH_EVENTS),
    "calendar_coverage": _sql("""
SELECT count(*) AS total_events, count(full_timestamp) AS covered_events,
       count(*) - count(full_timestamp) AS uncovered_events
FROM facts LEFT JOIN hours ON full_timestamp = hour_start
"""),
    "constraint_violations": _VIOLATIONS,
    "parsed_addresses": _sql("""
SELECT event_id, source_ip, source_ip LIKE '%:%' OR o[1] <> 10 AS is_external,
       o[1] * 16777216 + o[2] * 65536 + o[3] * 256 + o[4] AS source_ip_num
FROM texts LEFT JOIN (
  SELECT event_id, list_transform(string_split(source_ip, '.'), lambda t: CAST(t AS BIGINT)) AS o
  FROM texts WHERE source_ip NOT LIKE '%:%' AND source_ip NOT LIKE '300.%') USING (event_id)
""", _ADDRESS_TEXTS),
    "unreadable_addresses": _sql(
        "SELECT event_id, source_ip FROM texts WHERE source_ip LIKE '300.%'", _ADDRESS_TEXTS
    ),
    "loaded_events": _sql("""
SELECT event_id, source_ip, if(event_type = 'logout', 'login', event_type) AS event_type,
       CAST(event_timestamp AS DATE) AS event_date, is_external
FROM facts
"""),
    "orphan_events": _sql("""
SELECT event_id, 'user' AS missing FROM facts
WHERE user_id NOT IN (SELECT user_id FROM users WHERE department IS NOT NULL)
UNION ALL
SELECT event_id, 'host' FROM facts
WHERE dest_host_id NOT IN (SELECT host_id FROM hosts WHERE asset_criticality <> 'LOW')
"""),
}

_SECONDS = """
failed_seconds AS (
  SELECT user_id, source_ip, date_trunc('second', event_timestamp) AS s, count(*) AS n
  FROM recent WHERE NOT success GROUP BY ALL
),
rolled AS (
  SELECT *, sum(n) OVER (PARTITION BY user_id, source_ip ORDER BY s
                         RANGE BETWEEN INTERVAL 86400 SECONDS PRECEDING AND CURRENT ROW) AS c
  FROM failed_seconds
)"""

_SESSIONS = """
steps AS (
  SELECT user_id, dest_host_id, date_trunc('second', event_timestamp) AS s,
         bool_or(event_type = 'login') AS opened, bool_or(event_type = 'logout') AS closed
  FROM recent
  WHERE success AND dest_host_id IS NOT NULL AND event_type IN ('login', 'logout')
  GROUP BY ALL
),
paired AS (
  SELECT *, lead(s) OVER w AS next_s, lead(closed) OVER w AS next_closed FROM steps
  WINDOW w AS (PARTITION BY user_id, dest_host_id ORDER BY s)
)"""

_PROFILE = """
profile AS (
  SELECT user_id, username, department, is_privileged, count(*) AS total,
         count(*) FILTER (success) AS succeeded, count(*) FILTER (NOT success) AS failed,
         count(DISTINCT source_ip) AS ips, count(DISTINCT host_id) AS hosts_reached
  FROM recent e JOIN users USING (user_id) LEFT JOIN hosts ON host_id = e.dest_host_id
  GROUP BY ALL
)"""

_TRAILING_HOUR = """
stamped AS (SELECT *, date_trunc('second', event_timestamp) AS s FROM {events}),
rolling_hour AS (
  SELECT e.user_id, e.s, count(*) AS n, count(DISTINCT h.source_ip) AS ips
  FROM (SELECT DISTINCT user_id, s FROM stamped) e
  JOIN stamped h ON h.user_id = e.user_id AND h.s BETWEEN e.s - INTERVAL 3600 SECONDS AND e.s
  GROUP BY e.user_id, e.s
)"""

_PEAKS = """
peaks AS (
  SELECT user_id,
         (SELECT max(n) FROM (SELECT count(*) AS n FROM recent r WHERE r.user_id = u.user_id
                              GROUP BY CAST(event_timestamp AS DATE))) AS busiest_day,
         (SELECT max(ips) FROM rolling_hour t WHERE t.user_id = u.user_id) AS hour_ips
  FROM (SELECT DISTINCT user_id FROM recent) u
),
found AS (
  SELECT username, list_filter([
      if(failed > succeeded AND failed >= 5, 'under_attack', NULL),
      if(hour_ips >= 5, 'many_addresses', NULL),
      if(hosts_reached > 10 AND coalesce(department NOT LIKE 'IT %', true), 'wide_access', NULL),
      if(is_privileged AND failed >= 3, 'privileged_failures', NULL),
      if(total = 1, 'single_use', NULL),
      if(busiest_day > 100, 'busy_day', NULL),
      if(ips = 1 AND hosts_reached = 1, 'predictable', NULL)
    ], lambda f: f IS NOT NULL) AS f
  FROM profile JOIN peaks USING (user_id)
)"""

_DAILY = """
daily AS (
  SELECT user_id, CAST(event_timestamp AS DATE) AS date, count(*) AS events
  FROM recent GROUP BY ALL
),
busy_hours AS (
  SELECT user_id, CAST(s AS DATE) AS date, max(n) AS peak_hour_events FROM rolling_hour GROUP BY ALL
),
with_mean AS (
  SELECT *, avg(events) OVER (PARTITION BY user_id ORDER BY date
      RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING) AS baseline
  FROM daily
)"""

_DAILY_FAILURES = """
failures_by_day AS (
  SELECT CAST(event_timestamp AS DATE) AS date, count(*) AS failed_attempts
  FROM recent WHERE NOT success GROUP BY ALL
)"""

ORACLE |= {
    "sprayed_accounts": _sql("""
SELECT source_ip, username, count(*) AS failed_attempts, min(event_timestamp) AS first_attempt,
       max(event_timestamp) AS last_attempt
FROM recent JOIN users USING (user_id) WHERE NOT success GROUP BY source_ip, username
"""),
    "rolling_brute_force": _sql("""
SELECT username, department, is_privileged, source_ip, CAST(max(c) AS BIGINT) AS peak_failures,
       min(s) AS first_alert, max(s) AS last_alert
FROM rolled JOIN users USING (user_id) WHERE c >= 2
GROUP BY username, department, is_privileged, source_ip
""", _SECONDS),
    "spray_urgency": _sql("""
SELECT *, CASE WHEN users_1h >= 3 THEN 'urgent' WHEN users_24h >= 3 THEN 'high'
               ELSE 'monitor' END AS urgency
FROM (
  SELECT source_ip, max(n) FILTER (period = '1h') AS users_1h,
         max(n) FILTER (period = '24h') AS users_24h, max(n) FILTER (period = '7d') AS users_7d
  FROM spans GROUP BY source_ip)
WHERE greatest(users_1h, users_24h, users_7d) >= 3
""", """
hits AS (
  SELECT DISTINCT source_ip, user_id, date_trunc('second', event_timestamp) AS s
  FROM recent WHERE NOT success
),
spans AS (
  SELECT period, e.source_ip, e.s, count(DISTINCT h.user_id) AS n
  FROM (SELECT DISTINCT source_ip, s FROM hits) e
  CROSS JOIN (VALUES ('1h', 3600), ('24h', 86400), ('7d', 604800)) AS periods(period, seconds)
  JOIN hits h ON h.source_ip = e.source_ip
             AND h.s BETWEEN e.s - to_seconds(seconds) AND e.s
  GROUP BY ALL
)"""),
    "brute_force_by_privilege": _sql("""
SELECT username, department, is_privileged, count(*) AS failed_attempts, source_ip,
       min(event_timestamp) AS first_attempt, max(event_timestamp) AS last_attempt
FROM recent JOIN users USING (user_id) WHERE NOT success
GROUP BY ALL HAVING count(*) >= if(is_privileged, 2, 5)
"""),
    "distributed_brute_force": _sql("""
SELECT username, max(n) AS failed_attempts, max(ips) AS unique_ips,
       min(s) AS first_alert, max(s) AS last_alert
FROM rolling_hour JOIN users USING (user_id) WHERE n >= 2 AND ips >= 2 GROUP BY username
""", _TRAILING_HOUR.format(events="recent WHERE NOT success")),
    "logins_after_recent_failures": _sql("""
SELECT username, s.source_ip, s.event_timestamp AS successful_login_time,
       count(*) AS recent_failures
FROM recent s JOIN recent f ON f.user_id = s.user_id AND NOT f.success
 AND date_diff('second', date_trunc('second', f.event_timestamp),
               date_trunc('second', s.event_timestamp)) BETWEEN 1 AND 86400
JOIN users u ON u.user_id = s.user_id
WHERE s.success
GROUP BY s.event_id, username, s.source_ip, s.event_timestamp HAVING count(*) >= 3
"""),
    "spray_outcomes": _sql("""
SELECT source_ip, count(DISTINCT user_id) FILTER (NOT success) AS users_targeted,
       count(*) FILTER (success) AS successful_logins,
       count(DISTINCT user_id) FILTER (success) AS users_reached
FROM recent GROUP BY source_ip
HAVING count(DISTINCT user_id) FILTER (NOT success) >= 5 AND bool_or(success)
"""),
    "critical_asset_outcomes": _sql("""
SELECT hostname, asset_criticality, username, source_ip,
       count(*) FILTER (NOT success) AS failed_attempts,
       count(*) FILTER (success) AS successful_logins
FROM recent e JOIN users USING (user_id) JOIN hosts h ON h.host_id = e.dest_host_id
WHERE asset_criticality IN ('HIGH', 'CRITICAL')
GROUP BY ALL HAVING bool_or(success) AND bool_or(NOT success)
"""),
    "external_threat_levels": _sql("""
SELECT *, CASE
    WHEN successful_logins > 0 AND (failed_attempts >= 3 OR unique_users_targeted >= 5)
      THEN 'CRITICAL'
    WHEN (unique_users_targeted >= 5 AND failed_attempts >= 5) OR total_attempts > 100
      THEN 'HIGH'
    WHEN (unique_users_targeted >= 2 AND failed_attempts >= 3) OR total_attempts >= 10
      THEN 'MEDIUM'
    WHEN unique_users_targeted = 1 OR first_seen = last_seen THEN 'LOW'
    ELSE 'UNRATED' END AS threat_level
FROM (
  SELECT source_ip, count(*) AS total_attempts,
         count(*) FILTER (NOT success) AS failed_attempts,
         count(*) FILTER (success) AS successful_logins,
         count(DISTINCT user_id) AS unique_users_targeted,
         count(DISTINCT host_id) AS unique_hosts_targeted,
         min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen
  FROM recent e JOIN users USING (user_id) LEFT JOIN hosts h ON h.host_id = e.dest_host_id
  WHERE is_external GROUP BY source_ip)
"""),
    "account_anomalies": _sql("""
SELECT username, array_to_string(f, ', ') AS flags,
       CASE WHEN f[1] IN ('under_attack', 'many_addresses', 'wide_access') THEN 'CRITICAL'
            WHEN f[1] = 'predictable' THEN 'INFORMATIONAL' ELSE 'MODERATE' END AS level
FROM found WHERE len(f) > 0
""", _PROFILE, _TRAILING_HOUR.format(events="recent"), _PEAKS),
    "session_durations": _sql("""
SELECT username, hostname, s AS session_start, date_diff('second', s, next_s) AS duration_seconds
FROM paired JOIN users USING (user_id) JOIN hosts ON host_id = dest_host_id
WHERE opened AND next_closed AND date_diff('second', s, next_s) <= 86400
""", _SESSIONS),
    "concurrent_addresses": _sql("""
SELECT username, max(ips) AS unique_ips, min(s) AS first_alert, max(s) AS last_alert
FROM rolling_hour JOIN users USING (user_id) WHERE ips >= 2 GROUP BY username
""", _TRAILING_HOUR.format(events="recent")),
    "external_ip_summary_private_ranges": _external("recent", "LEFT", _NOT_PRIVATE),
    "activity_spikes": _sql("""
SELECT username, date, events, peak_hour_events, baseline
FROM with_mean JOIN busy_hours USING (user_id, date) JOIN users USING (user_id)
WHERE events > 2 * baseline
""", _TRAILING_HOUR.format(events="recent"), _DAILY),
    "peer_comparison": _sql("""
SELECT username, department, hosts_reached AS unique_hosts_accessed,
       avg(hosts_reached) OVER (PARTITION BY department) AS department_mean
FROM profile
""", _PROFILE),
    "dormant_accounts": _sql("""
SELECT username, department, is_privileged, max(event_timestamp) AS last_activity
FROM users LEFT JOIN facts USING (user_id) GROUP BY user_id, username, department, is_privileged
HAVING coalesce(max(event_timestamp) <= TIMESTAMP '2024-01-29', true)
"""),
    "shift_activity": _sql("""
SELECT CASE WHEN hour(event_timestamp) < 6 OR hour(event_timestamp) > 21 THEN 'NIGHT_SHIFT'
            WHEN hour(event_timestamp) < 14 THEN 'DAY_SHIFT' ELSE 'EVENING_SHIFT' END AS shift,
       CAST(event_timestamp AS DATE) = DATE '2024-01-15' AS is_holiday,
       count(*) AS event_count, count(*) FILTER (NOT success) AS failed_attempts
FROM recent GROUP BY ALL
"""),
    "week_over_week": _sql("""
SELECT t.date, t.failed_attempts, w.failed_attempts AS week_before,
       t.failed_attempts - w.failed_attempts AS change
FROM failures_by_day t LEFT JOIN failures_by_day w ON w.date = t.date - 7
""", _DAILY_FAILURES),
    "quarterly_trend": _sql("""
SELECT CAST(year(event_timestamp) AS INTEGER) AS year,
       CAST(quarter(event_timestamp) AS INTEGER) AS quarter,
       count(*) AS event_count, count(*) FILTER (NOT success) AS failed_attempts
FROM facts GROUP BY ALL
"""),
    "external_daily_activity": _sql("""
SELECT source_ip, CAST(event_timestamp AS DATE) AS date, count(*) AS total_attempts,
       count(*) FILTER (NOT success) AS failed_attempts,
       count(*) FILTER (success) AS successful_logins
FROM recent WHERE is_external GROUP BY ALL
"""),
    "lateral_movement": _sql("""
SELECT username, department, count(DISTINCT host_id) AS hosts_reached,
       CAST(count(DISTINCT asset_criticality) AS INTEGER) AS criticality_levels,
       string_agg(DISTINCT asset_criticality, ', ' ORDER BY asset_criticality) AS criticalities
FROM recent e JOIN users USING (user_id) JOIN hosts h ON h.host_id = e.dest_host_id
WHERE success AND department IS DISTINCT FROM 'MACHINERY'
GROUP BY username, department
HAVING count(DISTINCT host_id) > 9 OR count(DISTINCT asset_criticality) >= 4
"""),
}


def oracle_sql() -> dict[str, str]:
    from gatewarden.trial.load_oracle import ORACLE as LOADS  # its texts are built from these

    return ORACLE | LOADS
