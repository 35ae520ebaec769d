"""Plans and paths that only matter on large or skewed tables."""

import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from gatewarden.functions import rolling, shared, skew
from gatewarden.operators import accounts, assets, brute_force, compromise, external, scenarios
from gatewarden.sources.trial_tables import trial_warehouse
from tests.sample_star import event, star

FORCED = {"broadcast_bytes": 0, "rows_per_task": 50}


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 events; one (user, address) holds a third of them."""
    dice = random.Random(7)
    rows = []
    for n in range(3000):
        if n % 3 == 0:
            user, address = 1, "203.0.113.1"
        else:
            user, address = dice.randint(1, 11), f"10.0.0.{dice.randint(1, 40)}"
        outcome = "F" if dice.random() < 0.4 and n < 2500 else "S"
        day, minute = 1 + n // 110, (n % 110) * 13
        rows.append(
            event(n, user, dice.randint(1, 9), address, outcome,
                  f"2025-01-{day:02d} {minute // 60:02d}:{minute % 60:02d}:00")
        )
    return star(spark, events=rows)


def same(left, right) -> bool:
    return sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))


def test_split_compromises_equal_broadcast_ones(skewed):
    broadcast = compromise.compromised_same_address(skewed)
    assert broadcast.count() > 100
    assert same(broadcast, compromise.compromised_same_address(skewed, **FORCED))


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0}, {"most_marks": 1}])
def test_any_address_gives_one_row_per_success(skewed, limits):
    """Equal to following every failing address one by one, whichever way the marks are met."""
    found = compromise.compromised_any_address(skewed, **limits)
    failing = (
        skewed.events.filter("not success").groupBy("user_id", F.col("source_ip").alias("ip"))
        .agg(F.count("*").alias("n"), F.max("event_timestamp").alias("last"))
        .filter("n >= 3")
    )
    pairs = skewed.events.filter("success").join(failing, "user_id").filter(
        F.col("event_timestamp") > F.col("last")
    )
    expected = pairs.groupBy("event_id", "event_timestamp", "source_ip").agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.max("last").alias("last")
    ).select("event_timestamp", "source_ip", "k", "n", "last")
    assert expected.count() > 500
    assert same(expected, found.select(
        "successful_login_time", "source_ip", "failing_addresses", "failure_count", "last_failure"
    ).toDF(*expected.columns))


def test_successes_meet_short_marks_where_they_lie(skewed):
    """They are not shuffled to be put in order with the marks."""
    physical = plan_of(compromise.compromised_any_address(skewed))
    user_joins = [line for line in physical.splitlines() if "BroadcastHashJoin [user_id" in line]
    assert user_joins and "hashpartitioning(user_id" not in physical.split("BroadcastHashJoin [user_id")[-1].split("Scan")[0]
    long = plan_of(compromise.compromised_any_address(skewed, broadcast_bytes=0))
    assert "minute" not in physical and "minute" in long


def test_split_scenarios_equal_broadcast_ones(skewed):
    broadcast = scenarios.scenario_classification(skewed)
    split = scenarios.scenario_classification(skewed, broadcast_bytes=0, rows_per_task=5)
    assert same(broadcast, split)


def test_heavy_key_is_spread(skewed):
    """The rows of the hot pair reach many salts, and each meets its lookup row once."""
    keys = ["user_id", "source_ip"]
    weights = skewed.events.groupBy(*keys).agg(F.count("*").alias("weight"))
    heavy = skew.heaviest(weights, keys, 50)
    listed = heavy.orderBy(F.desc("splits")).first()
    assert (listed["user_id"], listed["source_ip"], listed["splits"]) == (1, "203.0.113.1", 20)
    joined = skew.spread_join(
        skewed.events, weights, keys, heavy, "event_id"
    )
    assert joined.count() == 3000
    assert joined.select("event_id").distinct().count() == 3000


def test_spread_left_join_keeps_unmatched_rows(spark, skewed):
    lookup = spark.createDataFrame([(1, "yes")], "user_id bigint, note string")
    weights = skewed.events.groupBy("user_id").agg(F.count("*").alias("weight"))
    heavy = skew.heaviest(weights, ["user_id"], 100)
    joined = skew.spread_join(skewed.events, lookup, ["user_id"], heavy, "event_id", "left")
    assert joined.count() == 3000
    assert joined.filter("note is null").select("user_id").distinct().count() == 10


def test_every_heavy_key_is_split(spark):
    weights = spark.range(5_000).select(F.col("id").alias("k"), (F.col("id") + 5).alias("weight"))
    heavy = skew.heaviest(weights, ["k"], 30)
    assert heavy.count() == 4_974
    assert heavy.filter(F.col("splits") != F.ceil((F.col("k") + 5) / 30)).isEmpty()


def test_the_list_of_heavy_keys_is_bounded_by_the_total(spark, monkeypatch):
    monkeypatch.setattr(skew, "LISTED_KEYS", 20)
    weights = spark.range(1_000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("weight"))
    assert skew.heaviest(weights, ["k"], 10).count() <= 20
    one = spark.range(1).select(F.col("id").alias("k"), F.lit(10**9).alias("weight"))
    assert skew.heaviest(one, ["k"], 10_000).first()["splits"] == 20


def test_size_of_a_lookup(spark):
    frame = spark.createDataFrame([(1, "abc"), (2, "é"), (3, None)], "k bigint, t string")
    assert skew.data_bytes(frame) == 3 * 16 + 3 + 2
    assert skew.data_bytes(frame.filter("false")) == 0


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    wh = trial_warehouse(spark, "/root/testdata/sf0.001")
    plan = plan_of(scenarios.kpi_summary(wh, "2024-01-08"))
    assert "GreaterThanOrEqual(ts,2024-01-08T00:00)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" \
        in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_calendar_range_reaches_the_scan(spark):
    from gatewarden.operators import temporal

    wh = trial_warehouse(spark, "/root/testdata/sf0.001")
    plan = plan_of(temporal.week_cells(wh, None))
    assert "LessThan(ts,2025-01-01T00:00)" in plan
    assert "Join" not in plan


def test_shared_results_use_the_named_folder(spark, shared_dir):
    folder = shared_dir / "gatewarden" / spark.sparkContext.applicationId
    before = set(folder.glob("*"))
    kept = shared.computed_once(spark.range(5).select(F.col("id").alias("n")))
    assert kept.count() == 5
    assert len(set(folder.glob("*")) - before) == 1


def test_shared_results_can_be_removed(spark, shared_dir):
    folder = shared_dir / "gatewarden" / spark.sparkContext.applicationId
    other = shared_dir / "gatewarden" / "another-application"
    other.mkdir(parents=True, exist_ok=True)
    shared.computed_once(spark.range(3)).count()
    assert folder.exists()
    assert shared.remove_shared_results(spark)
    assert not folder.exists() and other.exists()
    assert not shared.remove_shared_results(spark)
    assert shared.computed_once(spark.range(3)).count() == 3


class Session:
    """The two things ``shared_folder`` asks of a session."""

    def __init__(self, master: str):
        self.sparkContext = self
        self.conf = self
        self.master = master
        self.applicationId = f"app-{master}"

    def get(self, key, default=None):
        return default


def test_only_local_sessions_fall_back_to_a_temporary_folder():
    local = Session("local[2]")
    assert shared.shared_folder(local) == shared.shared_folder(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_folder(Session("spark://host:7077"))


def brute_trailing(rows, seconds, inclusive):
    """Per (key, second): sum of the amounts of the trailing period."""
    result = {}
    for key, second, _ in rows:
        last = second if inclusive else second - 1
        result[key, second] = sum(
            n for k, s, n in rows if k == key and second - seconds <= s <= last
        )
    return result


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("seconds", [10, 37])
def test_trailing_sums(spark, seconds, inclusive):
    dice = random.Random(seconds)
    times = {(dice.choice("ab"), dice.randint(0, 300)) for _ in range(150)}
    rows = [(key, second, dice.randint(0, 3)) for key, second in times]
    cells = spark.createDataFrame(rows, "k string, second bigint, n bigint")
    found = rolling.trailing(cells, ["k"], seconds, "n", "recent", inclusive)
    got = {
        (r["k"], r["second"]): r["recent"] or 0 for r in found.collect()
    }
    assert got == brute_trailing(rows, seconds, inclusive)
    assert found.columns == ["k", "second", "n", "recent"]


def test_next_cell(spark):
    dice = random.Random(3)
    seconds = sorted({dice.randint(0, 400) for _ in range(60)})
    cells = spark.createDataFrame([("a", s, s * 2) for s in seconds],
                                  "k string, second bigint, n bigint")
    found = rolling.following(cells, ["k"], 9, ["n"]).orderBy("second").collect()
    for row, later in zip(found, [*seconds[1:], None]):
        near = later is not None and later - row["second"] <= 9
        assert row["next_second"] == (later if near else None)
        assert row["next_n"] == (later * 2 if near else None)
    assert [r["second"] for r in found] == seconds


NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
SMALL_PARTITIONS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize(
    "job",
    [
        brute_force.brute_force, brute_force.password_spraying, accounts.privileged_audit,
        accounts.account_activity, external.external_ip_summary, assets.critical_asset_attacks,
    ],
)
def test_large_dimensions_give_the_same_rows(spark, skewed, job, monkeypatch):
    """Without any broadcast of a dimension, as with dimensions too large for one.

    Some jobs join it while they store a shared result, so those plans count too.
    """
    expected = job(skewed).collect()
    written = []

    def recorded(frame):
        written.append(plan_of(frame))
        return shared.computed_once(frame)

    for module in (brute_force, assets):
        monkeypatch.setattr(module, "computed_once", recorded)
    with settings(spark, NO_BROADCAST):
        frame = job(skewed)
        assert any("SortMergeJoin" in plan for plan in [*written, plan_of(frame)])
        assert frame.collect() == expected


def test_adaptive_execution_splits_a_hot_user(spark):
    """Raw rows joined to a large dimension: the hot partition is read by several tasks."""
    rows = [
        event(n, 9 if n % 3 else 10 + n % 2, 1, f"10.0.{n % 7}.{n % 200}", "S",
              f"2025-01-{1 + n % 28:02d} 10:{n % 60:02d}:00")
        for n in range(4000)
    ]
    wh = star(spark, events=rows)
    wh = wh.with_events(wh.events.repartition(8))
    with settings(spark, NO_BROADCAST | SMALL_PARTITIONS):
        audit = accounts.privileged_audit(wh)
        assert audit.count() == 4000
        audit.collect()
        assert "skew=true" in plan_of(audit)


def test_distinct_trailing_equals_brute_force(spark):
    dice = random.Random(11)
    rows = [
        (dice.randint(1, 3), f"m{dice.randint(1, 6)}", dice.randint(0, 60_000)) for _ in range(400)
    ]
    rows += [(1, "m1", 100), (1, "m1", 100 + 3600), (1, "m2", 100 + 3601), (1, "m3", 7200)]
    cells = spark.createDataFrame(rows, "k int, m string, second bigint")
    for seconds in (10, 3600, 86400):
        found = {
            (r["k"], r["second"]): r["n"]
            for r in rolling.distinct_trailing(cells, ["k"], "m", seconds, "n").collect()
        }
        expected = {
            (k, s): len({m for key, m, t in rows if key == k and s - seconds <= t <= s})
            for k, _, s in rows
        }
        assert found == expected


def test_attacks_across_the_full_hour_are_found(spark):
    from gatewarden.operators import risk_profiles, rolling_attacks

    rows = [
        event(n, 1, 1, f"10.0.0.{n}", "F", f"2025-01-20 {clock}")
        for n, clock in enumerate(("09:50:00", "09:55:00", "10:00:00", "10:05:00", "10:10:00"), 1)
    ]
    rows += [event(10 + n, n, 2, "10.9.9.9", "F", f"2025-01-20 {9 + n // 4:02d}:{50 if n < 4 else 10}:00")
             for n in range(1, 7)]
    wh = star(spark, events=rows)
    found = rolling_attacks.distributed_brute_force(wh, threshold=5, addresses=5).first()
    assert (found["username"], found["failed_attempts"], found["unique_ips"]) == ("jsmith", 6, 6)
    assert rolling_attacks.concurrent_addresses(wh, addresses=5).first()["username"] == "jsmith"
    urgent = rolling_attacks.spray_urgency(wh, threshold=6).first()
    assert (urgent["source_ip"], urgent["users_1h"], urgent["urgency"]) == ("10.9.9.9", 6, "urgent")
    flags = {r["username"]: r["flags"] for r in risk_profiles.account_anomalies(wh).collect()}
    assert "many_addresses" in flags["jsmith"]
