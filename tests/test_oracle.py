"""Every registered query against its SQL twin on the smallest data."""

import pytest

from conftest import SF
from geocadence.catalog import load_all
from geocadence.catalog.compare import compare, connect
from geocadence.catalog.registry import ORACLES, QUERIES

load_all()
NO_SQL = {"m5_cross_validation"}  # checked by brute force in test_kernel


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, message = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert ok, message


def test_all_but_the_listed_have_sql():
    assert set(QUERIES) - set(ORACLES) == NO_SQL


def test_entry_point(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0 and "rain_peak_3H:max" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
