"""DuckDB SQL of the queries over loads, periods and ordered steps."""

from __future__ import annotations

from gatewarden.trial.oracle import ORACLE as REPORTS
from gatewarden.trial.oracle import _sql, _tenths

_JUDGED = """
arriving AS (
  SELECT event_id AS n,
         CASE WHEN event_id % 100 = 1 THEN NULL WHEN event_id % 14 = 1 THEN event_id + 1
              WHEN event_id % 22 = 3 THEN event_id - 2 ELSE event_id END AS event_id,
         CASE WHEN event_id % 26 = 5 THEN -user_id WHEN event_id % 58 = 9 THEN NULL ELSE user_id END AS user_id,
         CASE WHEN event_id % 34 = 7 THEN 999999999 ELSE dest_host_id END AS dest_host_id,
         CASE WHEN event_id % 38 = 9 THEN '300.1.1.1' WHEN event_id % 62 = 11 THEN NULL
              WHEN event_id % 74 = 13 THEN '2001:db8::1' ELSE source_ip END AS source_ip,
         CASE WHEN event_id % 46 = 11 THEN NULL ELSE success END AS success,
         CASE WHEN event_id % 82 = 15 THEN NULL ELSE event_timestamp END AS event_timestamp
  FROM fact WHERE event_id % 2 = 1
),
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY event_id ORDER BY event_timestamp NULLS FIRST, user_id NULLS FIRST, source_ip NULLS FIRST,
      dest_host_id NULLS FIRST, success NULLS FIRST, n) AS copy
  FROM arriving
),
judged AS (
  SELECT *, list_filter([
    if(event_id IS NULL, 'event_id missing', NULL),
    if(event_id IS NOT NULL AND copy > 1, 'event_id repeated in the load', NULL),
    if(event_id IN (SELECT event_id FROM fact WHERE event_id % 2 = 0), 'event_id stored before', NULL),
    if(user_id IS NULL, 'user_id missing', NULL),
    if(user_id NOT IN (SELECT user_id FROM users), 'user_id unknown', NULL),
    if(dest_host_id NOT IN (SELECT host_id FROM hosts), 'dest_host_id unknown', NULL),
    if(source_ip IS NULL, 'source_ip missing', NULL),
    if(source_ip = '300.1.1.1', 'source_ip malformed', NULL),
    if(success IS NULL, 'success missing', NULL),
    if(event_timestamp IS NULL, 'event_timestamp missing', NULL)
  ], lambda r: r IS NOT NULL) AS reasons
  FROM placed
)"""

_PERIODS = """
inside AS (
  SELECT f.*, period_days FROM facts f CROSS JOIN (SELECT unnest([1, 7, 91]) AS period_days)
  WHERE CAST(event_timestamp AS DATE) <= DATE '2024-01-30'
    AND date_diff('day', CAST(event_timestamp AS DATE), DATE '2024-01-30') < period_days
)"""

_ENTRIES = """
cells AS (
  SELECT source_ip, user_id, date_trunc('second', event_timestamp) AS s,
         count(*) FILTER (NOT success) AS failures, count(*) FILTER (success) AS logins
  FROM recent GROUP BY ALL
),
sprays AS (
  SELECT a.source_ip, a.s, count(DISTINCT b.user_id) AS users_targeted
  FROM (SELECT DISTINCT source_ip, s FROM cells WHERE failures > 0) a
  JOIN cells b ON b.source_ip = a.source_ip AND b.failures > 0
              AND b.s BETWEEN a.s - INTERVAL 259200 SECONDS AND a.s
  GROUP BY a.source_ip, a.s HAVING count(DISTINCT b.user_id) >= 3
),
entries AS (
  SELECT c.source_ip, c.user_id, c.s, c.logins, max(k.s) AS sprayed_at, arg_max(k.users_targeted, k.s) AS users_targeted
  FROM cells c
  JOIN sprays k ON k.source_ip = c.source_ip AND k.s < c.s AND k.s >= c.s - INTERVAL 259200 SECONDS
  WHERE c.logins > 0 AND EXISTS (
    SELECT 1 FROM cells f WHERE f.source_ip = c.source_ip AND f.user_id = c.user_id AND f.failures > 0
      AND f.s < c.s AND f.s >= c.s - INTERVAL 259200 SECONDS)
  GROUP BY c.source_ip, c.user_id, c.s, c.logins
)"""

# 128-bit numbers: IPv4 addresses are those behind ::ffff:0:0/96.
_ZONES = """
written AS (
  SELECT format('10.{}.0.{}/{}', host_id % 3, host_id % 250, 24 + host_id % 9) AS network, hostname AS zone,
         host_id % 2 = 0 AS is_internal, 120 + host_id % 9 AS length,
         281470681743360::HUGEINT + 167772160 + (host_id % 3) * 65536 + host_id % 250 AS number FROM hosts
  UNION ALL
  SELECT format('10.{}.0.0/16', host_id % 3), asset_criticality, true, 112,
         281470681743360::HUGEINT + 167772160 + (host_id % 3) * 65536 FROM hosts
  UNION ALL
  SELECT format('198.51.{}.0/24', host_id % 5), location, false, 120,
         281470681743360::HUGEINT + 3325231104 + (host_id % 5) * 256 FROM hosts
  UNION ALL
  SELECT '2001:db8:' || lower(to_hex(host_id % 40)) || '::/' || (44 + host_id % 5), location, true, 44 + host_id % 5,
         42540766411282592856903984951653826560::HUGEINT + (host_id % 40)::HUGEINT * 1208925819614629174706176 FROM hosts
),
labels AS (SELECT network, min({'zone': zone, 'is_internal': is_internal}) AS label FROM written GROUP BY network),
sized AS (SELECT network, length, number, CAST(pow(2, 128 - length) AS HUGEINT) AS size FROM written),
blocks AS (SELECT length, size, number // size AS prefix, min(network) AS network FROM sized GROUP BY ALL),
seen AS (
  SELECT user_id, success,
    CASE WHEN event_id % 7 = 0 THEN '2001:db8:' || lower(to_hex(user_id % 40)) || '::' || lower(to_hex(event_id % 5))
      ELSE source_ip END AS source_ip,
    CASE WHEN event_id % 7 = 0
      THEN 42540766411282592856903984951653826560::HUGEINT + (user_id % 40)::HUGEINT * 1208925819614629174706176 + event_id % 5
      ELSE 281470681743360::HUGEINT + split_part(source_ip, '.', 1)::BIGINT * 16777216
        + split_part(source_ip, '.', 2)::BIGINT * 65536 + split_part(source_ip, '.', 3)::BIGINT * 256
        + split_part(source_ip, '.', 4)::BIGINT END AS number
  FROM recent
),
placed AS (
  SELECT source_ip, arg_max(network, length) AS network
  FROM (SELECT DISTINCT source_ip, number FROM seen) a JOIN blocks b ON a.number // b.size = b.prefix GROUP BY source_ip
)"""

_HABITS = """
habits AS (
  SELECT user_id, kind, value,
         count(*) FILTER (CAST(event_timestamp AS DATE) = DATE '2024-01-30') AS now,
         count(*) FILTER (CAST(event_timestamp AS DATE) < DATE '2024-01-30') AS before
  FROM (
    SELECT user_id, event_timestamp, 'hour' AS kind, hour(event_timestamp)::VARCHAR AS value FROM facts
    UNION ALL SELECT user_id, event_timestamp, 'address', source_ip FROM facts
    UNION ALL SELECT user_id, event_timestamp, 'host', dest_host_id::VARCHAR FROM facts WHERE dest_host_id IS NOT NULL)
  WHERE CAST(event_timestamp AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-30'
  GROUP BY ALL
),
sums AS (
  SELECT user_id, CAST(sum(now) AS BIGINT) AS events_today, CAST(sum(before) AS BIGINT) AS events_before
  FROM habits WHERE kind = 'hour' GROUP BY user_id HAVING sum(now) > 0 AND sum(before) >= 10
),
unlike AS (
  SELECT user_id, events_today, events_before,
         CAST(sum(abs(now * events_before - before * events_today)) FILTER (kind = 'hour') AS DOUBLE)
           / CAST(2 * events_today * events_before AS DOUBLE) AS hour_distance,
         count(*) FILTER (kind = 'hour' AND now > 0 AND before = 0) AS new_hours,
         count(*) FILTER (kind = 'address' AND now > 0 AND before = 0) AS new_addresses,
         count(*) FILTER (kind = 'host' AND now > 0 AND before = 0) AS new_hosts
  FROM habits JOIN sums USING (user_id) GROUP BY user_id, events_today, events_before
)"""

ORACLE: dict[str, str] = {
    "zone_activity": _sql("""
SELECT p.network, coalesce(label.zone, 'unlisted') AS zone, coalesce(label.is_internal, false) AS is_internal,
       count(*) AS total_attempts, count(*) FILTER (NOT success) AS failed_attempts,
       count(DISTINCT source_ip) AS unique_ips, count(DISTINCT user_id) AS unique_users
FROM seen LEFT JOIN placed p USING (source_ip) LEFT JOIN labels l ON l.network = p.network
GROUP BY p.network, label
""", _ZONES),
    "address_trends": _sql("""
SELECT t.source_ip, t.period_start, CAST(t.days AS INTEGER) AS days, t.attempts, t.slope,
       CASE WHEN t.slope > 0 THEN 'rising' WHEN t.slope < 0 THEN 'falling' ELSE 'steady' END AS trend,
       coalesce(b.attempts, 0) AS previous_attempts, t.attempts - coalesce(b.attempts, 0) AS change
FROM sloped t LEFT JOIN sloped b ON b.source_ip = t.source_ip AND b.period_start = t.period_start - INTERVAL 7 DAYS
""", """
ends AS (SELECT CAST(min(event_timestamp) AS DATE) AS first, CAST(max(event_timestamp) AS DATE) AS last FROM recent),
weeks AS (
  SELECT DISTINCT source_ip, CAST(date_trunc('week', event_timestamp) AS DATE) AS period_start FROM recent WHERE is_external
),
filled AS (
  SELECT source_ip, period_start, CAST(d AS DATE) AS day,
         date_diff('day', greatest(period_start, first), CAST(d AS DATE)) AS x,
         (SELECT count(*) FROM recent r WHERE r.source_ip = w.source_ip AND CAST(r.event_timestamp AS DATE) = CAST(d AS DATE)) AS y
  FROM (
    SELECT source_ip, period_start, first,
      unnest(generate_series(greatest(period_start, first), least(period_start + 6, last), INTERVAL 1 DAY)) AS d
    FROM weeks, ends) w
),
sloped AS (
  SELECT source_ip, period_start, count(*) AS days, CAST(sum(y) AS BIGINT) AS attempts,
         CASE WHEN count(*) > 1 THEN CAST(count(*) * sum(x * y) - sum(x) * sum(y) AS DOUBLE)
           / CAST(count(*) * sum(x * x) - sum(x) * sum(x) AS DOUBLE) END AS slope
  FROM filled GROUP BY source_ip, period_start
)"""),
    "period_changes": _sql("""
SELECT period_start, event_count, failed_attempts, event_count - lag(event_count) OVER o AS event_change,
       failed_attempts - lag(failed_attempts) OVER o AS failed_change
FROM (
  SELECT CAST(date_trunc('week', event_timestamp) AS DATE) AS period_start, count(*) AS event_count,
         count(*) FILTER (NOT success) AS failed_attempts
  FROM facts GROUP BY 1)
WINDOW o AS (ORDER BY period_start)
"""),
    "shift_activity_as_of": _sql("""
SELECT CASE WHEN v.host_id IS NULL THEN NULL WHEN hour(event_timestamp) >= 22 OR hour(event_timestamp) < 6 + v.host_id % 3 THEN 'NIGHT'
            WHEN hour(event_timestamp) < 14 THEN 'DAY' ELSE 'EVENING' END AS shift,
       d.holiday, count(*) AS event_count, count(*) FILTER (NOT success) AS failed_attempts
FROM recent e
LEFT JOIN hosts v ON v.host_id = (
  SELECT max(host_id) FROM hosts WHERE host_id <= 4 AND DATE '2024-01-01' + CAST(6 * host_id AS INTEGER) <= CAST(e.event_timestamp AS DATE))
LEFT JOIN (
  SELECT DATE '2024-01-08' + CAST(host_id % 17 AS INTEGER) AS day, min(location) AS holiday
  FROM hosts WHERE asset_criticality = 'CRITICAL' GROUP BY 1) d ON d.day = CAST(e.event_timestamp AS DATE)
GROUP BY ALL
"""),
    "unusual_days": _sql("""
SELECT username, department, events_today, events_before, hour_distance, new_hours, new_addresses, new_hosts,
       array_to_string(found, ', ') AS flags
FROM (
  SELECT *, list_filter([
    if(new_hours > 0 AND hour_distance >= 0.5, 'unusual_hours', NULL),
    if(new_addresses >= 3, 'new_addresses', NULL),
    if(new_hosts >= 3 AND coalesce(department NOT IN ('IT Security', 'IT Ops', 'IT Support'), true), 'new_hosts', NULL)
  ], lambda f: f IS NOT NULL) AS found
  FROM unlike JOIN users USING (user_id))
WHERE len(found) > 0
""", _HABITS),
    "rejected_events": _sql("""
SELECT event_id, user_id, dest_host_id, source_ip, array_to_string(reasons, '; ') AS reasons
FROM judged WHERE len(reasons) > 0
""", _JUDGED),
    "intake_outcomes": _sql("""
SELECT outcome, count(*) AS rows FROM (
  SELECT unnest(if(len(reasons) = 0, ['accepted'], reasons)) AS outcome FROM judged
) GROUP BY outcome
""", _JUDGED),
    "executive_dashboard_after_loads": REPORTS["executive_dashboard"],
    "scenario_classification_after_loads": REPORTS["scenario_classification"],
    "kpi_summary_after_loads": REPORTS["kpi_summary"],
    "soc_dashboard_document_after_loads": REPORTS["soc_dashboard_document"],
    "spraying_over_periods": _sql("""
SELECT period_days, source_ip, count(DISTINCT user_id) AS users_targeted, count(*) AS total_attempts,
       min(event_timestamp) AS attack_start, max(event_timestamp) AS attack_end
FROM inside WHERE NOT success GROUP BY period_days, source_ip HAVING count(DISTINCT user_id) >= 5
""", _PERIODS),
    "external_over_periods": _sql("""
SELECT period_days, source_ip, count(*) AS total_attempts, count(*) FILTER (NOT success) AS failed_attempts,
       count(*) FILTER (success) AS successful_logins, min(event_timestamp) AS first_seen,
       max(event_timestamp) AS last_seen, count(DISTINCT user_id) AS unique_users_targeted,
       count(DISTINCT dest_host_id) AS unique_hosts_targeted
FROM inside WHERE is_external GROUP BY period_days, source_ip
""", _PERIODS),
    "business_hours_over_periods": _sql(f"""
SELECT period_days, is_business_hours, total_attacks, unique_attackers, unique_targets,
       {_tenths("succeeded", "total_attacks")} AS success_rate_percent
FROM (
  SELECT period_days, is_business_hours, count(*) AS total_attacks, count(DISTINCT source_ip) AS unique_attackers,
         count(DISTINCT user_id) AS unique_targets, count(*) FILTER (success) AS succeeded
  FROM inside JOIN hours ON full_timestamp = hour_start GROUP BY period_days, is_business_hours)
""", _PERIODS),
    "spray_entries": _sql("""
SELECT source_ip, username, users_targeted, sprayed_at, s AS entered_at, logins
FROM entries JOIN users USING (user_id)
""", _ENTRIES),
    "spray_movements": _sql("""
SELECT username, ip AS source_ip, entered_at, hostname, asset_criticality, min(l.s) AS moved_at,
       CAST(sum(l.logins) AS BIGINT) AS logins
FROM latest l JOIN users USING (user_id) JOIN hosts h ON h.host_id = l.dest_host_id
GROUP BY username, ip, entered_at, hostname, asset_criticality
""", _ENTRIES, """
entered AS (SELECT user_id, s, max(source_ip) AS ip FROM entries GROUP BY user_id, s),
host_logins AS (
  SELECT user_id, dest_host_id, date_trunc('second', event_timestamp) AS s, count(*) AS logins
  FROM recent WHERE success AND dest_host_id IS NOT NULL GROUP BY ALL
),
latest AS (
  SELECT h.user_id, h.dest_host_id, h.s, h.logins, max(e.s) AS entered_at, arg_max(e.ip, e.s) AS ip
  FROM host_logins h JOIN entered e
    ON e.user_id = h.user_id AND e.s < h.s AND e.s >= h.s - INTERVAL 259200 SECONDS
  GROUP BY h.user_id, h.dest_host_id, h.s, h.logins
)"""),
}
