"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
import compare

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return compare.tables(SF)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, db, key):
    result = QUERIES[key](spark, SF)
    if key in ORACLES:
        assert compare.difference(result, db, ORACLES[key]) is None
    else:
        assert result.count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
