"""Every registered query with a SQL twin, compared on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_contract(spark):
    names = contract.queries()
    assert set(contract.oracle_sql()) <= set(names) and len(names) > 100
    assert contract.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(contract.oracle_sql()[name])
    assert compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall()) is None


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert contract.queries()[name](spark, SF).count() > 0
