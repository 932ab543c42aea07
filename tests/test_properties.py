"""Relations that hold over whole tables, whatever the layout of the input."""

from __future__ import annotations

import pytest
from compare import SF_DIR
from fixtures import tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trailmill.catalog import QUERIES, inputs
from trailmill.operators import funnel, histograms, sampling, sessions
from trailmill.schemas import STEP_LENGTH_BUCKETS, VISIT_LENGTH_BUCKETS


@pytest.fixture(scope="module")
def rolled(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('rolled')}/sessions"
    sessions.session_rollup(inputs.actions(spark, SF_DIR)).write.parquet(path)
    return spark.read.parquet(path)


def test_buckets_add_up(rolled):
    row = histograms.session_histogram(rolled).first()
    total = rolled.count()
    still = rolled.where("visit_length = 0").count()
    assert row.session_count == total
    assert sum(row[n] for n in STEP_LENGTH_BUCKETS) == total
    assert sum(row[n] for n in VISIT_LENGTH_BUCKETS) + still == total


@pytest.mark.parametrize("total", [1, 10, 100, 5000])
def test_sample_stays_within_its_shares(rolled, total):
    drawn = sampling.sample_sessions(rolled, total, seed=9)
    days = sampling.with_start_hour(rolled).select("date").distinct().count()
    per_day = drawn.groupBy("date").count().collect()
    assert all(row["count"] <= total // days for row in per_day)
    assert drawn.join(rolled, "session_id", "left_semi").count() == drawn.count()
    assert drawn.select("session_id").distinct().count() == drawn.count()


def test_pairs_are_rows_less_sessions(spark, rolled):
    actions = inputs.actions(spark, SF_DIR)
    pairs = funnel.page_pairs(actions).agg(F.sum("pv")).first()[0]
    assert pairs == actions.count() - rolled.count()


@pytest.mark.parametrize("name", ["session_rollup", "page_pairs", "session_sample", "ad_province_top3"])
def test_partitions_do_not_change_results(spark, name):
    def rows():
        df = QUERIES[name](spark, SF_DIR)
        return tuples(df, *df.columns)

    before, key = rows(), "spark.sql.shuffle.partitions"
    was = spark.conf.get(key)
    try:
        spark.conf.set(key, "3")
        assert rows() == before
    finally:
        spark.conf.set(key, was)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    visits=st.lists(
        st.tuples(st.sampled_from("abc"), st.integers(0, 3000), st.integers(0, 4)),
        min_size=1,
        max_size=40,
    ),
)
def test_pairs_of_any_visits(spark, visits):
    rows = [(s, t, p, n) for n, (s, t, p) in enumerate(visits)]
    df = spark.createDataFrame(rows, "session_id string, t long, page_id long, event_id long")
    df = df.withColumn("ts", F.timestamp_seconds("t"))
    expected: dict = {}
    for session in "abc":
        pages = [p for _, _, p in sorted((t, n, p) for s, t, p, n in rows if s == session)]
        for pair in zip(pages, pages[1:]):
            expected[pair] = expected.get(pair, 0) + 1
    got = funnel.page_pairs(df)
    assert {(a, b): n for a, b, n in tuples(got, "from_page", "to_page", "pv")} == expected
