from __future__ import annotations

import pytest
from fixtures import actions, at, tuples, users
from pyspark.sql import functions as F

from trailmill.operators import histograms, sampling, sessions
from trailmill.params import DateRange, SessionFilter
from trailmill.schemas import STEP_LENGTH_BUCKETS, VISIT_LENGTH_BUCKETS
from trailmill.sources import tables


def test_hours_without_padding_are_ordered_as_times(spark):
    got = sessions.session_rollup(
        actions(
            spark,
            {"action_time": "2019-04-21 10:00:00"},
            {"action_time": "2019-04-21 3:05:07"},
        )
    )
    row = sessions.session_text(got).first()
    assert row.start_time == "2019-04-21 03:05:07"
    assert row.visit_length == 6 * 3600 + 54 * 60 + 53


def test_future_times_have_true_lengths(spark):
    got = sessions.session_rollup(
        actions(
            spark,
            {"action_time": "2099-01-01 1:00:00"},
            {"action_time": "2099-01-01 1:00:05"},
        )
    )
    assert got.first().visit_length == 5


def test_values_contained_in_others_are_kept(spark):
    got = sessions.session_rollup(
        actions(
            spark,
            {"action_time": at(1), "click_category_id": 12, "search_keyword": "新辣道鱼火锅"},
            {"action_time": at(2), "click_category_id": 1, "search_keyword": "火锅"},
            {"action_time": at(3), "click_category_id": 12, "search_keyword": ""},
        )
    ).first()
    assert got.click_category_ids == [1, 12]
    assert sorted(got.search_keywords) == sorted(["新辣道鱼火锅", "火锅"])
    assert got.step_length == 3


def test_session_without_clicks_has_no_category(spark):
    got = sessions.session_rollup(actions(spark, {"action_time": at(1)}))
    row = sessions.session_text(got).first()
    assert row.click_category_ids == "" and row.search_keywords == ""


def test_date_bounds_are_independent(spark):
    rows = actions(
        spark,
        *[{"date": f"2024-01-0{d}", "action_time": at(d), "page_id": d} for d in (1, 2, 3)],
    )

    def pages(dates):
        return [p for (p,) in tuples(tables.scan_actions(rows, dates), "page_id")]

    assert pages(DateRange()) == [1, 2, 3]
    assert pages(DateRange(start="2024-01-02")) == [2, 3]
    assert pages(DateRange(end="2024-01-02")) == [1, 2]
    assert pages(DateRange("2024-01-02", "2024-01-02")) == [2]


def _sessions_of(spark, lengths, steps):
    rows = [(f"v{n}", n, 1) for n in lengths] + [(f"s{n}", 0, n) for n in steps]
    return spark.createDataFrame(rows, "session_id string, visit_length long, step_length long")


def test_bucket_edges(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60, 179, 180, 599, 600, 1799, 1800]
    steps = [1, 3, 4, 6, 7, 9, 10, 29, 30, 60, 61]
    got = histograms.session_histogram(_sessions_of(spark, lengths, steps)).first().asDict()
    assert got["session_count"] == len(lengths) + len(steps)
    assert [got[name] for name in VISIT_LENGTH_BUCKETS] == [2] * 8 + [1]
    # Every visit-length row above is a session of one step.
    assert [got[name] for name in STEP_LENGTH_BUCKETS] == [2 + len(lengths), 2, 2, 2, 2, 1]
    assert sum(got[n] for n in VISIT_LENGTH_BUCKETS) + 1 + len(steps) == got["session_count"]


def test_ratios_round_half_up_and_survive_no_sessions(spark):
    histogram = histograms.session_histogram(_sessions_of(spark, [2] * 29 + [0] * 171, []))
    assert histograms.session_ratios(histogram).first()["1s_3s"] == 0.15
    none = histograms.session_histogram(_sessions_of(spark, [5], []).where("false"))
    row = histograms.session_ratios(none).first()
    assert row.session_count == 0 and row["4s_6s"] == 0.0


PEOPLE = [
    (1, "u1", "n1", 20, "doctor", "rome", "male"),
    (2, "u2", "n2", 50, "baker", "oslo", "female"),
    (3, "u3", "n3", None, None, None, None),
]


@pytest.fixture(scope="module")
def enriched(spark):
    rows = actions(
        spark,
        {"session_id": "a", "user_id": 1, "action_time": at(1), "search_keyword": "cake"},
        {"session_id": "a", "user_id": 1, "action_time": at(2), "click_category_id": 7},
        {"session_id": "b", "user_id": 2, "action_time": at(1), "search_keyword": "spa"},
        {"session_id": "c", "user_id": 3, "action_time": at(1)},
        {"session_id": "d", "user_id": 9, "action_time": at(1)},
    )
    return sessions.enrich_sessions(sessions.session_rollup(rows), users(spark, *PEOPLE))


@pytest.mark.parametrize(
    "given, passing",
    [
        ({}, "abc"),
        ({"start_age": 20, "end_age": 50}, "ab"),
        ({"start_age": 21, "end_age": 50}, "b"),
        ({"start_age": 60}, "abc"),
        ({"end_age": 1}, "abc"),
        ({"professionals": ["doctor", "smith"]}, "a"),
        ({"cities": ["oslo"]}, "b"),
        ({"sex": ["male", "female"]}, "ab"),
        ({"keywords": ["cake", "spa"]}, "ab"),
        ({"keywords": ["ca"]}, ""),
        ({"category_ids": [7]}, "a"),
        ({"category_ids": [77]}, ""),
        ({"sex": ["male"], "keywords": ["spa"]}, ""),
        ({"sex": ["female"], "keywords": ["spa"], "start_age": 50, "end_age": 50}, "b"),
    ],
)
def test_filter(enriched, given, passing):
    got = tuples(sessions.filter_sessions(enriched, SessionFilter(**given)), "session_id")
    assert "".join(s for (s,) in got) == passing


def test_equal_predicate(enriched):
    assert sessions.equal(F.col("sex"), None) is None
    got = enriched.where(sessions.equal(F.col("sex"), "male"))
    assert tuples(got, "session_id") == [("a",)]


def test_details_keep_missing_ids_missing(spark):
    rows = actions(spark, {"action_time": at(1)}, {"session_id": "s2", "action_time": at(2)})
    chosen = spark.createDataFrame([("s1",)], "session_id string")
    got = sessions.detail_rows(sessions.session_details(rows, chosen), 5).collect()
    assert len(got) == 1
    assert got[0].task_id == 5 and got[0].click_category_id is None


def _started(spark, counts: dict[tuple[int, int], int]):
    rows = [
        (f"d{day}h{hour}n{n}", f"2024-01-{day:02d} {hour:02d}:00:00")
        for (day, hour), count in counts.items()
        for n in range(count)
    ]
    df = spark.createDataFrame(rows, "session_id string, start_time string")
    return df.withColumn("start_time", F.col("start_time").cast("timestamp"))


def test_sample_follows_the_hours(spark):
    started = _started(spark, {(1, 1): 1, (1, 2): 2, (1, 3): 7, (2, 5): 4})
    got = sampling.sample_sessions(started, total=10, seed=3)
    # 5 per day: 0.5, 1 and 3.5 of day 1 rounded down; day 2 has only 4 sessions.
    assert tuples(got.groupBy("date", "hour").count(), "date", "hour", "count") == [
        ("2024-01-01", "02", 1),
        ("2024-01-01", "03", 3),
        ("2024-01-02", "05", 4),
    ]
    assert got.select("session_id").distinct().count() == 8
    assert got.join(started, "session_id", "left_anti").count() == 0


def test_sample_is_repeatable_and_seeded(spark):
    started = _started(spark, {(1, h): 40 for h in range(6)})
    first = tuples(sampling.sample_sessions(started, 30, seed=1), "session_id")
    again = tuples(sampling.sample_sessions(started.repartition(13), 30, seed=1), "session_id")
    other = tuples(sampling.sample_sessions(started, 30, seed=2), "session_id")
    assert first == again and len(first) == 30
    assert first != other


def test_sample_larger_than_the_group_limit(spark):
    started = _started(spark, {(1, 1): 3000, (1, 2): 1000})
    got = sampling.sample_sessions(started, 2000, seed=1)
    assert tuples(got.groupBy("hour").count(), "hour", "count") == [("01", 1500), ("02", 500)]


def test_sample_details_cover_every_sampled_session(spark):
    rows = actions(
        spark,
        *[{"session_id": f"s{i}", "action_time": at(i)} for i in range(10) for _ in range(2)],
    )
    rolled = sessions.session_rollup(rows)
    chosen = sampling.sample_sessions(rolled, total=5)
    got = sampling.sample_details(rows, chosen)
    assert got.count() == 10
    assert got.select("session_id").distinct().count() == 5


def test_rollup_ignores_input_order_and_partitions(spark):
    rows = actions(
        spark,
        *[
            {
                "session_id": f"s{i % 3}",
                "action_time": at(i * 37 % 5000),
                "click_category_id": i % 7,
                "search_keyword": "ab"[i % 2],
            }
            for i in range(100)
        ],
    )
    columns = ["session_id", "visit_length", "step_length", "click_category_ids"]
    first = tuples(sessions.session_rollup(rows), *columns)
    shuffled = rows.repartition(11).sortWithinPartitions(F.desc("event_id"))
    assert tuples(sessions.session_rollup(shuffled), *columns) == first
