"""Every catalogue query against its SQL in DuckDB."""

import pytest
from compare import differences, duck
from conftest import SF_DIR

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = df.collect()
    assert rows and len(df.columns) == len(set(df.columns))


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "onset_us" in df.columns
