"""Every registered query with a SQL twin gives the same rows as DuckDB on the smallest tables."""

import pytest
from testdata_paths import SF_SMALL
from oracle_compare import compare

import __spark_entry__ as entry

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    res = compare(QUERIES[name](spark, SF_SMALL), SQL[name], SF_SMALL)
    assert res["ok"], res


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "win" in df.columns
