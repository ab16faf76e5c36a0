"""Every query with SQL against DuckDB on the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    problem = compare(spark, duck, SF, name)
    if problem == "EMPTY":  # two empty results prove nothing
        problem = compare(spark, connect(LARGER), LARGER, name)
    assert problem is None


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
