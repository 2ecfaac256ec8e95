"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(spark, con, key):
    assert compare(QUERIES[key](spark, SF), con, ORACLE[key]) == ""


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_has_rows(spark, key):
    df = QUERIES[key](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_is_flagship(spark):
    rows = entry.entry(spark).collect()
    assert [r["ranking"] for r in rows] == list(range(1, len(rows) + 1))


def test_both_leaderboards_agree(spark):
    a, b = (QUERIES[k](spark, SF).collect() for k in ("leaderboard_agg", "leaderboard_window"))
    assert a == b
