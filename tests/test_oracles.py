"""Every registered query against its SQL, and the contract of the entry module."""

import pytest

import __spark_entry__ as contract
from comparing import compare, tables_db

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return tables_db(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) is None
    else:
        assert not df.isEmpty()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() == 20
