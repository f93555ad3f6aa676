"""Every registered query against its SQL at the smallest scale."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        assert compare(df, con, SQL[name]) is None
    else:
        assert len(df.collect()) > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 12 and df.count() == 6000


def test_sql_names_are_registered():
    assert set(SQL) <= set(QUERIES)
