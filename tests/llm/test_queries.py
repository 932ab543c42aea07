"""The registered queries that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest
from compare import difference, duckdb_over

import __spark_entry__ as entry
from trailmill.llm import oracles, queries

FOLDER = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= entry.queries().keys()


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_matches_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), duckdb_over(FOLDER), oracles.ORACLES[name]) is None
