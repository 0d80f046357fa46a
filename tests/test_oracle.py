"""Every registered query with an oracle text against DuckDB at sf0.001."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

from conftest import SF_SMALL

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL)
    assert r["status"] in ("exact", "close"), r


def test_every_query_has_a_callable():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) >= 67


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "forecast_id" in df.columns and "insight_summary" in df.columns
