"""Texts of the executive report."""

# Category titles in report order.
OVERALL = "📊 OVERALL METRICS"
INCIDENTS = "🚨 CRITICAL INCIDENTS"
TOP_THREATS = "🎯 TOP THREATS"
TIMELINE = "📅 ATTACK TIMELINE"
ACTORS = "👤 THREAT ACTORS"
RECOMMENDATIONS = "✅ RECOMMENDATIONS"
CATEGORIES = (OVERALL, INCIDENTS, TOP_THREATS, TIMELINE, ACTORS, RECOMMENDATIONS)

# Metric titles; those ending in a colon and blank precede a name.
TOTAL_EVENTS = "Total Security Events"
FAILED_LOGINS = "Failed Login Attempts"
SUCCESSFUL_LOGINS = "Successful Logins"
EXTERNAL_SOURCES = "External Attack Sources"
PRIVILEGED_ACTIVE = "Privileged Accounts Active"
SUCCESSFUL_BRUTE = "Successful Brute"
SPRAYING_DETECTED = "Password Spraying Attacks Detected"
CRITICAL_ATTACKS = "Attacks on CRITICAL Assets"
MOST_ATTACKED_USER = "Most Attacked User: "
MOST_ATTACKED_SERVER = "Most Attacked Server: "
MOST_DANGEROUS_IP = "Most Dangerous IP: "
FIRST_ATTACK = "First Attack Recorded"
LATEST_ATTACK = "Most Recent Attack"
PEAK_DAY = "Peak Attack Day"
IMMEDIATE_ACTIONS = "Immediate Actions Required"
IPS_TO_BLOCK = "IPs to Block"
USERS_TO_TRAIN = "Users Requiring Training"

# Units after counts.
EVENTS = "event(s)"
ATTEMPTS = "attempt(s)"
LOGINS = "login(s)"
SOURCES = "source(s)"
ACCOUNTS = "account(s)"
BRUTES = "brute(s)"
ATTACKS = "attack(s)"
SERVERS_TARGETED = "servers targeted"
USERS_TARGETED = "user(s) targeted"
ACTIONS = "action(s)"
ADDRESSES = "IP(s)"
USERS = "user(s)"

# Detail texts.
NOT_INTERNAL = "Non-internal IPs"
PRIVILEGED_MARK = " (PRIVILEGED)"
CRITICALITY_MARK = " criticality"
MONITORING_SINCE = "Monitoring since"
LAST_FAILED_LOGIN = "Last failed login"
RESET_PASSWORDS = "Compromised accounts needing password reset"
FAILED_EXTERNAL = "External IPs with failed attacks"
SUSPICIOUS_USERS = "Users with suspicious activity patterns"

# Severity marks and verdicts on external addresses.
RED, ORANGE, YELLOW, GREEN = "🔴", "🟠", "🟡", "🟢"
OK, WARNING, LOCK, PIN, CHART = "✅", "⚠️", "🔐", "📍", "📊"
ACTOR_BRUTE_FORCE = "🔴 Successful Brute Force"
ACTOR_SPRAYING = "🔴 Password Spraying"
ACTOR_LOGIN = "🟡 Successful External Login"
ACTOR_BLOCKED = "🟢 Blocked"
