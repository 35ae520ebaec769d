"""The driver contract: every query has SQL, and both give the same rows."""

import pytest

import __spark_entry__ as contract
from gatewarden.operators import brute_force
from gatewarden.sources.trial_tables import trial_warehouse
from gatewarden.trial import oracle
from gatewarden.trial import queries as registered
from tests.oracle_check import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(registered.queries()) == set(oracle.oracle_sql())
    assert set(registered.queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark, connection):
    frame = contract.entry(spark)
    theirs = connection.execute(contract.oracle_sql()["brute_force"]).df()
    assert len(theirs) > 0 and compare(frame.toPandas(), theirs) is None
    assert frame.columns[0] == "username"
    everything = brute_force.brute_force(trial_warehouse(spark, SF_DIR), since=None)
    every = connection.execute(oracle._brute("facts")).df()
    assert len(every) > len(theirs) and compare(everything.toPandas(), every) is None


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_sql(spark, connection, name):
    ours = contract.queries()[name](spark, SF_DIR).toPandas()
    theirs = connection.execute(contract.oracle_sql()[name]).df()
    assert compare(ours, theirs) is None


@pytest.mark.parametrize(
    "name",
    ["attacks_by_hour", "calendar", "executive_dashboard", "high_risk_period_attacks",
     "hunt_compromises", "hunt_privileged_activity", "rolling_brute_force", "session_durations",
     "shift_activity", "week_over_week", "privileged_off_hours_detail"],
)
def test_results_do_not_depend_on_the_session_zone(spark, connection, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ours = contract.queries()[name](spark, SF_DIR).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    theirs = connection.execute(contract.oracle_sql()[name]).df()
    assert compare(ours, theirs) is None
