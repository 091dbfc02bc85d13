"""Every registered query with SQL against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check_queries as check

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return check.connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, folder, con, name):
    assert check.compare(entry.queries()[name](spark, folder), con, ORACLES[name]) is None


def test_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert {r["split"] for r in df.collect()} == {"train", "val", "test"}
