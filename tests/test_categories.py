from __future__ import annotations

from fixtures import actions, at, tuples

from trailmill.operators import categories, ranking
from pyspark.sql import functions as F


def test_one_click_counts_one(spark):
    rows = actions(spark, {"action_time": at(1), "click_category_id": 4})
    got = categories.category_session_clicks(rows)
    assert tuples(got, "category_id", "session_id", "click_count") == [(4, "s1", 1)]


def test_counts_of_all_kinds(spark):
    rows = actions(
        spark,
        {"click_category_id": 4},
        {"order_category_ids": "4,9", "pay_category_ids": "9"},
        {"order_category_ids": "4"},
        {"search_keyword": "x"},
    )
    got = categories.category_counts(rows)
    assert tuples(got, "category_id", "click_count", "order_count", "pay_count") == [
        (4, 1, 2, 0),
        (9, 0, 1, 1),
    ]
    assert tuples(categories.visited_categories(rows), "category_id") == [(4,), (9,)]


def test_three_sort_keys_beyond_int_range(spark):
    big = 2**31
    counts = spark.createDataFrame(
        [
            (1, big + 5, 0, 0),
            (2, 3, 9, 9),
            (3, 3, 9, 10),
            (4, 3, 8, 99),
            (5, 3 * big, 0, 0),
            (6, 3, 9, 9),
        ],
        "category_id long, click_count long, order_count long, pay_count long",
    )
    top = categories.top_categories(counts, 5).collect()
    assert [row.category_id for row in top] == [5, 1, 3, 2, 6]


def test_top_sessions_break_ties_by_session(spark):
    rows = actions(
        spark,
        *[
            {"session_id": f"s{n:02d}", "action_time": at(n), "click_category_id": 1}
            for n in range(12)
        ],
        {"session_id": "s99", "click_category_id": 1},
        {"session_id": "s99", "click_category_id": 1},
        {"session_id": "s99", "click_category_id": 2},
    )
    top = spark.createDataFrame([(1,)], "category_id long")
    got = categories.top_sessions_by_category(rows, top, 10)
    assert [r for (r,) in tuples(got, "session_id")] == [f"s{n:02d}" for n in range(9)] + ["s99"]
    assert got.where("rank = 1").first().session_id == "s99"


def test_details_repeat_a_session_per_category_it_tops(spark):
    rows = actions(
        spark,
        {"click_category_id": 1},
        {"click_category_id": 2},
        {"session_id": "other", "search_keyword": "x"},
    )
    top = categories.top_categories(categories.category_counts(rows))
    best = categories.top_sessions_by_category(rows, top)
    got = categories.top_session_details(rows, best)
    assert tuples(got.groupBy("category_id").count(), "category_id", "count") == [(1, 2), (2, 2)]


def test_top_n_beyond_the_group_limit(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    got = ranking.top_n_per_group(df, ["g"], [F.desc("v")], 1500)
    assert tuples(got.groupBy("g").agg(F.min("v").alias("low")), "g", "low") == [
        (0, 4998 - 2 * 1499),
        (1, 4999 - 2 * 1499),
    ]
    assert got.where("rank = 1").count() == 2 and got.count() == 3000
