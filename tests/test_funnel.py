from __future__ import annotations

import random

import pytest
from fixtures import actions, at, tuples
from pyspark.sql import functions as F

from trailmill.operators import funnel
from trailmill.params import PageFlow, ParameterError
from trailmill.sources.tables import with_event_time


def _pairs(rows):
    return {(a, b): n for a, b, n in tuples(funnel.page_pairs(rows), "from_page", "to_page", "pv")}


@pytest.fixture
def ranges(spark):
    """Sets the number of ranges, which small inputs would otherwise be merged into one of."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {key: spark.conf.get(key) for key in keys}

    def use(count):
        spark.conf.set(keys[0], str(count))
        spark.conf.set(keys[1], "false")

    yield use
    for key, value in before.items():
        spark.conf.set(key, value)


def _brute(rows: list[tuple[str, int, int, int]]):
    """(session, seconds, id, page) -> pair counts."""
    counts: dict = {}
    by_session: dict = {}
    for session, *rest in rows:
        by_session.setdefault(session, []).append(tuple(rest))
    for visits in by_session.values():
        pages = [page for _, _, page in sorted(visits)]
        for pair in zip(pages, pages[1:]):
            counts[pair] = counts.get(pair, 0) + 1
    return counts


def test_pairs_follow_time_and_count_once(spark):
    rows = actions(
        spark,
        {"action_time": "2019-04-21 10:00:03", "page_id": 3},
        {"action_time": "2019-04-21 9:00:01", "page_id": 1},
        {"action_time": "2019-04-21 9:30:02", "page_id": 2},
        {"session_id": "s2", "action_time": at(5), "page_id": 2},
        {"session_id": "s2", "action_time": at(1), "page_id": 1},
    )
    assert _pairs(rows) == {(1, 2): 2, (2, 3): 1}


@pytest.mark.parametrize("count", [1, 7, 40, 200])
def test_split_sessions_give_the_same_pairs(spark, ranges, count):
    ranges(count)
    rng = random.Random(4)
    data = [
        ("hot" if n % 3 else f"s{n % 40}", rng.randrange(20_000), n, rng.randrange(6))
        for n in range(600)
    ]
    rows = actions(
        spark,
        *[
            {"session_id": s, "action_time": at(t), "page_id": p}
            for s, t, _, p in data
        ],
    )
    assert _pairs(rows) == _brute(data)


def test_a_session_within_one_moment_is_split(spark, ranges):
    ranges(8)
    rows = spark.range(0, 20_000, 1, 4).selectExpr(
        "'hot' AS session_id", "timestamp'2024-01-01 00:00:00' AS ts", "id AS event_id", "id % 9 AS page_id"
    )
    sizes = [r.n for r in funnel.visit_ranges(rows).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 20_000 / 4
    pairs = _pairs(rows)
    assert sum(pairs.values()) == 19_999 and pairs.keys() == {(p, (p + 1) % 9) for p in range(9)}


def test_missing_pages_and_batches_of_arrow(spark, ranges):
    ranges(3)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        rows = [("a", t, p) for t, p in enumerate((1, None, None, 2, 1))] + [("b", t, 1) for t in range(6)]
        df = spark.createDataFrame(rows, "session_id string, t long, page_id long").withColumn("ts", F.timestamp_seconds("t"))
        assert _pairs(df) == {(1, None): 1, (None, None): 1, (None, 2): 1, (2, 1): 1, (1, 1): 5}
        steps = funnel.page_steps(df).groupBy("from_page").agg(F.sum("visits").alias("visits"))
        assert {r.from_page: r.visits for r in steps.collect()} == {1: 8, 2: 1, None: 2}
        assert _pairs(df.where("false")) == {}
    finally:
        spark.conf.set(key, before)


def test_rows_without_a_session_make_no_pairs(spark):
    rows = actions(
        spark,
        {"session_id": None, "action_time": at(0), "page_id": 1},
        {"session_id": None, "action_time": at(1), "page_id": 2},
        {"session_id": "s", "action_time": at(2), "page_id": 1},
        {"session_id": "s", "action_time": at(90), "page_id": 2},
    )
    assert _pairs(rows) == {(1, 2): 1}


def test_rates_of_steps_equal_those_of_pairs_and_visits(spark):
    rows = actions(
        spark, *[{"session_id": f"s{n % 3}", "action_time": at(n * 37), "page_id": n % 4} for n in range(60)]
    )
    flow = PageFlow((1, 2, 3, 1))
    columns = ("step", "page_split", "pv", "base_pv", "convert_rate")
    acted = with_event_time(rows)
    expected = funnel.conversion_rates(funnel.page_pairs(acted), funnel.page_visits(acted), flow)
    assert tuples(funnel.rates_of_steps(funnel.page_steps(acted), flow), *columns) == tuples(expected, *columns)


def test_pairs_without_event_id(spark):
    rows = actions(
        spark,
        *[{"action_time": at(t), "page_id": p} for t, p in ((1, 1), (2, 2), (700, 3), (701, 1))],
        with_id=False,
    )
    assert _pairs(rows) == {(1, 2): 1, (2, 3): 1, (3, 1): 1}


def _rates(spark, flow, *rows):
    acted = actions(spark, *rows)
    return funnel.conversion_rates(funnel.page_pairs(acted), funnel.page_visits(acted), flow)


def test_start_page_counts_rows_not_sessions(spark):
    rows = (
        {"action_time": at(1), "page_id": 1},
        {"action_time": at(2), "page_id": 2},
        {"action_time": at(3), "page_id": 1},
        {"session_id": "s2", "action_time": at(1), "page_id": 5},
    )
    flow = PageFlow((1, 2))
    assert funnel.start_page_visits(actions(spark, *rows), flow).first().start_pv == 2
    row = _rates(spark, flow, *rows).first()
    assert (row.pv, row.base_pv, row.convert_rate) == (1, 2, 0.5)


def test_step_after_an_empty_step_is_zero(spark):
    rows = (
        {"session_id": "a", "action_time": at(1), "page_id": 1},
        {"session_id": "b", "action_time": at(1), "page_id": 3},
        {"session_id": "b", "action_time": at(2), "page_id": 4},
    )
    got = _rates(spark, PageFlow((1, 2, 3, 4)), *rows)
    assert tuples(got, "step", "pv", "base_pv", "convert_rate") == [
        (1, 0, 1, 0.0),
        (2, 0, 0, 0.0),
        (3, 1, 0, 0.0),
    ]


def test_no_visit_of_the_start_page(spark):
    got = _rates(spark, PageFlow((1, 2)), {"action_time": at(1), "page_id": 7})
    assert tuples(got, "pv", "base_pv", "convert_rate") == [(0, 0, 0.0)]


def test_repeated_pair_keeps_its_places(spark):
    rows = [{"action_time": at(t), "page_id": p} for t, p in enumerate((1, 2, 1, 2))]
    got = _rates(spark, PageFlow((1, 2, 1, 2)), *rows)
    assert tuples(got, "step", "page_split", "pv", "base_pv", "convert_rate") == [
        (1, "1_2", 2, 2, 1.0),
        (2, "2_1", 1, 2, 0.5),
        (3, "1_2", 2, 1, 2.0),
    ]
    assert funnel.encode_rates(got).first().convert_rate == "1_2=1.0|2_1=0.5|1_2=2.0"


def test_flow_pairs(spark):
    pairs = spark.createDataFrame([(1, 2, 5), (2, 1, 6), (2, 3, 7)], "from_page long, to_page long, pv long")
    got = funnel.flow_pairs(pairs, PageFlow((1, 2, 3)))
    assert tuples(got, "from_page", "to_page", "pv") == [(1, 2, 5), (2, 3, 7)]


def test_flow_needs_two_pages():
    with pytest.raises(ParameterError):
        PageFlow.parse("1")
