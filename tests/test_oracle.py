"""Every registered query with an oracle equals DuckDB on sf0.01."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF01
from tests.oracle_check import compare, duck

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF01), con, SQL[name])
    assert res["ok"], res


def test_every_query_is_registered_with_a_callable():
    assert set(SQL) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "churn" in df.columns
