"""Every query with an SQL statement gives the same rows in Spark and DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from tests import oracle

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    if name in SQL:
        assert oracle.compare(spark, con, QUERIES[name], SQL[name], SF_DIR) is None
    else:
        QUERIES[name](spark, SF_DIR).collect()


def test_names_agree():
    assert set(SQL) <= set(QUERIES)


def test_flagship_query(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "category", "spent", "limit", "over_by"]
    assert df.count() > 0
