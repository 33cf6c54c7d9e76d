"""Every registered query with SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(key, spark, small_folder, small_db):
    assert compare(QUERIES[key](spark, small_folder), small_db, ORACLES[key]) is None


def test_every_query_is_well_formed():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_returns_rows(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["cat", "count", "mean", "std", "min", "max"]
    assert frame.count() > 0
