"""Every registered query against its SQL on the whole smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck
from ordertide.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.registered(), oracle.statements()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(entry.queries()) >= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    rows = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert rows > 0


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "biz_type", "customer_id", "order_cnt", "amount_sum"]
    assert df.count() > 0
