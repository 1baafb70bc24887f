"""Every registered query against its SQL on the smallest test tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    problem, _ = difference(spark, con, SF, QUERIES[name], ORACLES[name])
    assert problem is None, problem


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["symbol", "price_date"]
