"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
import catalog
import oracle


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_matches_sql(spark, sf, con, name):
    sql = catalog.ORACLES[name]
    assert oracle.compare(catalog.QUERIES[name](spark, sf), con, sql) == []


def test_entry_point_names_them_all():
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
