"""Every query that has SQL, on the small tables, against DuckDB."""

from __future__ import annotations

import pytest
from check_queries import connect, difference

import __spark_entry__ as entry

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, con, name):
    problem, _ = difference(entry.queries()[name](spark, sf), con, SQL[name])
    assert problem is None, problem


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["event_type", "ds", "y"]


def test_every_check_has_a_query():
    assert set(SQL) <= set(entry.queries())
