"""Every registered query against its SQL over the same tables."""

from __future__ import annotations

import pytest
from compare import SF_DIR, difference, duckdb_over

import __spark_entry__ as entry
from trailmill import catalog


@pytest.fixture(scope="module")
def con():
    return duckdb_over(SF_DIR)


def test_every_query_has_sql():
    assert catalog.QUERIES.keys() == catalog.ORACLES.keys()
    assert catalog.QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_matches_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns[:4] == ["area", "area_level", "product_id", "click_count"]
    assert 0 < rows.count() <= 15
