"""Alerts over the hour that trails each event, and sessions, as streams.

They need a session whose state store is RocksDB (``session.STREAMING``). Event times
are cast under the session's UTC for the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gatewarden.functions.clock import epoch_second
from gatewarden.functions.rolling import moment
from gatewarden.streaming.ordered import OrderedSeconds

HOUR = 3600
DAY = 86400
LOGIN, LOGOUT = 1, 2


def _timed(events: DataFrame, lateness: str) -> DataFrame:
    return (
        events.withColumn("event_time", F.col("event_timestamp").cast("timestamp"))
        .withWatermark("event_time", lateness)
        .withColumn("second", epoch_second(F.col("event_timestamp")))
    )


# --- spraying -----------------------------------------------------------------------------


class Presence(StatefulProcessor):
    """When a user counts for an address: from each failure until ``period`` seconds later.

    The state of an (address, user) is its few spans that are not over yet. Only what changes
    at the spans' ends goes on, as +1 and -1 at a second; nothing is said of times before
    the watermark, as a row that comes in time cannot change them.
    """

    def __init__(self, period: int):
        self.period = period

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getValueState("spans", "bounds array<bigint>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        bounds = list(self.spans.get()[0]) if self.spans.exists() else []
        spans = list(zip(bounds[::2], bounds[1::2]))
        changes: dict[int, int] = {}

        def change(span: tuple[int, int], by: int) -> None:
            for second, amount in ((span[0], by), (span[1] + 1, -by)):
                changes[second] = changes.get(second, 0) + amount

        for second in sorted({row.second for row in rows}):
            own = (second, second + self.period)
            touched = [s for s in spans if s[0] <= own[1] and own[0] <= s[1]]
            merged = (min([own[0], *(s[0] for s in touched)]), max([own[1], *(s[1] for s in touched)]))
            for span in touched:
                change(span, -1)
            change(merged, 1)
            spans = [s for s in spans if s not in touched] + [merged]
        self._keep(spans, timerValues)
        return iter([
            Row(source_ip=key[0], at=datetime.fromtimestamp(second, UTC), second=second, amount=amount)
            for second, amount in sorted(changes.items()) if amount
        ])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.spans.exists():
            bounds = list(self.spans.get()[0])
            self._keep(list(zip(bounds[::2], bounds[1::2])), timerValues)
        return iter([])

    def _keep(self, spans: list[tuple[int, int]], timerValues) -> None:
        passed = timerValues.getCurrentWatermarkInMs() // 1000
        spans = sorted(s for s in spans if s[1] >= passed)
        if not spans:
            self.spans.clear()
            return
        self.spans.update(([b for s in spans for b in s],))
        self.handle.registerTimer((spans[-1][1] + 1) * 1000)

    def close(self) -> None:
        pass


class Crossing(OrderedSeconds):
    """The running number of users of an address; a row each time it rises to the threshold."""

    def __init__(self, threshold: int):
        self.threshold = threshold

    def step(self, key, second, amount, state):
        before = state[0] if state else 0
        now = before + amount
        rows = []
        if before < self.threshold <= now:
            rows = [Row(source_ip=key[0], second=second, users_targeted=now)]
        return ((now,) if now else None), rows


def rolling_spraying_alerts(events: DataFrame, seconds: int = HOUR, threshold: int = 5,
                            lateness: str = "1 hour") -> DataFrame:
    """Addresses that failed against ``threshold`` users within any trailing ``seconds``.

    → source_ip, alert_time, users_targeted. One row when the number of users reaches the
    threshold, and another only after it fell below. A hot address is spread over its users;
    its own state is a number, and the changes of the seconds that are still open.
    """
    failures = _timed(events.filter(~F.col("success")), lateness)
    changes = failures.select("source_ip", "user_id", "event_time", "second").groupBy("source_ip", "user_id").transformWithState(
        Presence(seconds), "source_ip string, at timestamp, second bigint, amount bigint",
        outputMode="Append", timeMode="EventTime", eventTimeColumnName="at",
    )
    alerts = changes.groupBy("source_ip").transformWithState(
        Crossing(threshold), "source_ip string, second bigint, users_targeted bigint",
        outputMode="Append", timeMode="EventTime",
    )
    return alerts.select("source_ip", moment(F.col("second")).alias("alert_time"), "users_targeted")


# --- logins after failures ----------------------------------------------------------------


def compromise_alerts(events: DataFrame, seconds: int = HOUR, threshold: int = 3, same_address: bool = False,
                      lateness: str = "1 hour") -> DataFrame:
    """Logins with ``threshold`` failures of the user in the ``seconds`` before, once per second.

    → user_id, (source_ip,) login_time, logins, recent_failures. Failures of the login's own second do
    not count. Both sides are added up per second before they are joined within the period, so
    a hot user meets at most the seconds of one period, and both watermarks bound the state.
    """
    keys = ["user_id", *(["source_ip"] if same_address else [])]

    def per_second(rows: DataFrame, count: str, prefix: str) -> DataFrame:
        counted = (
            _timed(rows, lateness).groupBy(F.window("event_time", "1 second").alias("w"), *keys)
            .agg(F.count("*").alias(count))
        )
        # The last moment of the second stands for it, as it carries the watermark.
        return counted.select(*[F.col(k).alias(f"{prefix}_{k}") for k in keys], F.window_time("w").alias(f"{prefix}_at"), count)

    failures = per_second(events.filter(~F.col("success")), "failures", "f")
    logins = per_second(events.filter("success"), "logins", "l")
    same = [F.col(f"l_{k}") == F.col(f"f_{k}") for k in keys]
    near = F.expr(f"f_at < l_at AND f_at >= l_at - INTERVAL {seconds} SECONDS")
    joined = logins.join(failures, [*same, near])
    return (
        joined.groupBy(F.window("l_at", "1 second").alias("w"), *[F.col(f"l_{k}").alias(k) for k in keys])
        .agg(F.max("logins").alias("logins"), F.sum("failures").alias("recent_failures"))
        .filter(F.col("recent_failures") >= threshold)
        .select(*keys, F.col("w.start").cast("timestamp_ntz").alias("login_time"), "logins", "recent_failures")
    )


# --- sessions -----------------------------------------------------------------------------


class Sessions(OrderedSeconds):
    """The second of a login that waits for its logout, up to ``longest`` seconds."""

    def __init__(self, longest: int):
        self.longest = longest

    def combined(self, a, b):
        return a | b

    def step(self, key, second, amount, state):
        rows = []
        if state and amount & LOGOUT and second - state[0] <= self.longest:
            rows = [Row(user_id=key[0], dest_host_id=key[1], second=state[0], duration_seconds=second - state[0])]
        return ((second,) if amount & LOGIN else None), rows

    def expires(self, state):
        return state[0] + self.longest


def session_stream(events: DataFrame, longest: int = DAY, lateness: str = "1 hour") -> DataFrame:
    """Login to next logout of the same user and host, as soon as the watermark has passed it.

    → user_id, dest_host_id, session_start, duration_seconds. A new login in between ends the
    search; a login without a logout within ``longest`` seconds is forgotten.
    """
    kind: Column = F.when(F.col("event_type") == "login", LOGIN).when(F.col("event_type") == "logout", LOGOUT)
    activity = events.filter(F.col("success") & F.col("dest_host_id").isNotNull()).withColumn("amount", kind.cast("bigint"))
    timed = _timed(activity.filter(F.col("amount").isNotNull()), lateness)
    sessions = timed.select("user_id", "dest_host_id", "event_time", "second", "amount").groupBy("user_id", "dest_host_id").transformWithState(
        Sessions(longest), "user_id bigint, dest_host_id bigint, second bigint, duration_seconds bigint",
        outputMode="Append", timeMode="EventTime",
    )
    return sessions.select("user_id", "dest_host_id", moment(F.col("second")).alias("session_start"), "duration_seconds")
