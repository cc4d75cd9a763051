"""Every registered query against its DuckDB SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as entry
import check
import oracles
from fixtures.registry import QUERIES as REGISTERED
from tests.conftest import SMALL

QUERIES, ORACLES = {name: entry.queries()[name] for name in REGISTERED}, oracles.oracle_sql()


@pytest.fixture(scope="module")
def duckdb():
    return check.connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql_and_stays_on_the_jvm(spark, duckdb, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert node not in plan, node
    assert check.compare(df, duckdb.sql(ORACLES[name])) == []


def test_every_query_has_sql_and_every_sql_a_query():
    assert set(QUERIES) == set(ORACLES)


def test_every_operator_of_the_inventory_is_registered():
    groups = {"s": 8, "i": 10, "c": 63, "v": 21}
    wanted = {f"{g}{n}" for g, count in groups.items() for n in range(1, count + 1)} | {"m1", "m2", "m3"}
    assert wanted == {name.split("_")[0] for name in QUERIES}


def test_entry_returns_the_scorecard(spark):
    card = entry.entry(spark)
    assert card.columns[-2:] == ["HealthScore", "OverallHealth"] and card.count() > 0
