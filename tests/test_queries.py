"""Every registered query against its SQL, and what its plan must not contain."""

import pytest

import __spark_entry__ as registered
from tests.compare import assert_same, duck

SF = "/root/testdata/sf0.001"
QUERIES = registered.core_queries()
ORACLES = registered.core_oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ExistingRDD"):
        assert slow not in plan
    assert_same(df, connection, ORACLES[name])


def test_entry(spark):
    df = registered.entry(spark)
    assert df.count() > 0
    assert dict(df.dtypes)["net_amount"] == "decimal(18,2)"
