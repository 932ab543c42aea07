"""The shape of the plans: what reaches the scan, what is shuffled, what is broadcast."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from compare import SF_DIR
from fixtures import actions, at, tuples, users

import __spark_entry__ as entry
from trailmill import catalog
from trailmill import schemas
from trailmill.operators import ads, categories, funnel, products, sessions
from trailmill.params import DateRange, JobParams, PageFlow, ParameterError, SessionFilter
from trailmill.plans import reports
from trailmill.sources import derived, tables


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The behaviour tables as stored parquet."""
    root = tmp_path_factory.mktemp("stored")
    for name in ("user_visit_action", "user_info", "city_info", "product_info"):
        getattr(derived, name)(spark, SF_DIR).write.parquet(f"{root}/{name}")
    return {
        name: tables.read_table(spark, f"{root}/{name}")
        for name in ("user_visit_action", "user_info", "city_info", "product_info")
    }


def test_clicks_read_three_columns_and_push_filters(stored):
    text = plan(tables.scan_clicks(stored["user_visit_action"], DateRange("2024-01-02", "2024-01-09")))
    assert "ReadSchema: struct<date:string,click_product_id:bigint,city_id:bigint>" in text
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for part in ("IsNotNull(click_product_id)", "GreaterThanOrEqual(date", "LessThanOrEqual(date"):
        assert part in pushed


def test_user_predicates_reach_the_user_scan(stored):
    rolled = sessions.session_rollup(stored["user_visit_action"])
    text = plan(
        sessions.filter_sessions(
            sessions.enrich_sessions(rolled, stored["user_info"]),
            SessionFilter(sex=["male"], cities=["NATION_1"]),
        )
    )
    assert "EqualTo(sex,male)" in text and "EqualTo(city,NATION_1)" in text


def test_top_n_trims_groups_before_the_shuffle(spark, stored):
    counts = categories.category_session_clicks(stored["user_visit_action"])
    top = categories.top_categories(categories.category_counts(stored["user_visit_action"]))
    best = categories.top_sessions_by_category(stored["user_visit_action"], top)
    assert plan(best).count("WindowGroupLimit") >= 2
    assert "TakeOrderedAndProject" in plan(top)
    assert counts.columns == ["category_id", "session_id", "click_count"]


def test_products_count_before_joining(stored):
    text = plan(
        products.area_product_clicks(
            tables.scan_clicks(stored["user_visit_action"]), stored["city_info"]
        )
    )
    assert text.index("partial_count(1)") < text.index("partial_collect_set")


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    if name.startswith(("stream_", "sink_")):
        pytest.skip("runs jobs when called")
    text = plan(entry.queries()[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert bad not in text, bad


def test_rollup_combines_before_the_shuffle(stored):
    text = plan(sessions.session_rollup(stored["user_visit_action"]))
    assert "partial_count(1)" in text and "ObjectHashAggregate" in text


def test_page_pairs_read_and_shuffle_the_actions_once(stored):
    text = _final_plan(funnel.page_pairs(stored["user_visit_action"]))
    final = text[: text.index("Initial Plan")]
    assert final.count("FileScan") == 1
    # By range; then the counts, which the map side has combined, twice by page.
    assert final.count("rangepartitioning(session_id") == 1
    assert final.count("Exchange hashpartitioning(from_page") == 2
    assert "hashpartitioning(session_id" not in final


def test_session_report(spark, stored, tmp_path):
    out, flow = str(tmp_path), PageFlow((1, 2, 3, 4))
    params = JobParams(
        7,
        DateRange("2024-01-01", "2024-01-31"),
        SessionFilter(20, 50, sex=["male"], keywords=["cake", "spa"], category_ids=[1, 2, 3, 4, 5]),
        flow,
    )
    for _ in range(2):  # a second run replaces the first
        reports.session_report(
            spark, stored["user_visit_action"], stored["user_info"], params, out, seed=42
        )
        reports.page_report(stored["user_visit_action"], params, out)
        reports.product_report(
            stored["user_visit_action"],
            stored["city_info"],
            stored["product_info"],
            params,
            out,
            {"A": ["AFRICA", "AMERICA"], "B": ["ASIA"], "C": ["EUROPE"]},
            "D",
        )
    queries = {
        "session_aggr_stat": "session_ratios",
        "session_random_extract": "session_sample",
        "session_sample_detail": "session_sample_detail",
        "top10_category": "top10_category",
        "top10_category_session": "top10_category_session",
        "top10_session_detail": "top10_session_detail",
    }
    for name, query in queries.items():
        got = reports.read_result(spark, out, name, reports.SESSION_RESULTS[name])
        columns = [c for c in got.columns if c != "task_id"]
        assert tuples(got, *columns) == tuples(entry.queries()[query](spark, SF_DIR), *columns), name
        assert tuples(got.select("task_id").distinct(), "task_id") == [(7,)]
    rate = reports.read_result(spark, out, "page_split_convert_rate", schemas.PAGE_SPLIT_CONVERT_RATE)
    assert tuples(rate, "convert_rate") == tuples(
        entry.queries()["page_convert_rate_encoded"](spark, SF_DIR), "convert_rate"
    )
    best = reports.read_result(spark, out, "area_top3_product", schemas.AREA_TOP3_PRODUCT)
    columns = [c for c in best.columns if c != "task_id"]
    assert tuples(best, *columns) == tuples(
        entry.queries()["area_top3_product"](spark, SF_DIR), *columns
    )


def test_page_report_needs_a_flow(stored, tmp_path):
    with pytest.raises(ParameterError):
        reports.page_report(stored["user_visit_action"], JobParams(1), str(tmp_path))


def test_views_can_be_registered_twice(spark):
    acted = actions(spark, {"action_time": at(1)})
    for _ in range(2):
        tables.register_views({"user_visit_action": acted, "user_info": users(spark, (1, "u", "n", 5, "p", "c", "male"))})
    assert spark.sql("select count(*) n from user_visit_action join user_info using (user_id)").first().n == 1


def test_anti_join_of_streams_is_salted(spark):
    log = spark.createDataFrame([], schemas.AD_LOG)
    listed = spark.createDataFrame([], schemas.AD_BLACKLIST)
    assert "salt" in plan(ads.exclude_users(log, listed, salts=4))


def test_csv_and_json_sources(spark, tmp_path):
    (tmp_path / "c.csv").write_text("1,rome,south\n2,oslo,north\n")
    got = tables.read_table(spark, str(tmp_path / "c.csv"), "city_info", "csv")
    assert tuples(got, "city_id", "city_name", "area") == [(1, "rome", "south"), (2, "oslo", "north")]
    (tmp_path / "p.json").write_text('{"product_id": 1, "product_name": "x", "extend_info": "{}"}\n')
    assert tables.read_table(spark, str(tmp_path / "p.json"), "product_info", "json").first().product_id == 1


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tiny_partitions(spark):
    """Settings under which a few kilobytes count as a skewed partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def hot_rows(spark, tmp_path):
    """Stored actions of 200 small sessions and users, and one session and user with 20,000."""
    base = actions(
        spark, *[{"session_id": f"s{n}", "user_id": n, "action_time": at(n)} for n in range(200)]
    )
    hot = spark.range(0, 20_000, 1, 16).selectExpr("id", "'hot' AS session_id", "7 AS user_id")
    wide = hot.selectExpr(
        "'2019-04-21' AS date", "cast(user_id AS long) user_id", "session_id", "id % 9 AS page_id",
        "'2019-04-21 1:00:00' AS action_time", "uuid() AS search_keyword",
        "cast(NULL AS long) click_category_id", "cast(NULL AS long) click_product_id",
        "cast(NULL AS string) order_category_ids", "cast(NULL AS string) order_product_ids",
        "cast(NULL AS string) pay_category_ids", "cast(NULL AS string) pay_product_ids",
        "cast(1 AS long) city_id", "id + 1000 AS event_id",
    )
    base.unionByName(wide).write.parquet(f"{tmp_path}/hot")
    return spark.read.parquet(f"{tmp_path}/hot")


def test_hot_session_is_split_in_the_detail_join(spark, hot_rows, tiny_partitions):
    rows = hot_rows
    chosen = rows.select("session_id").where("session_id <> 's1'").distinct()
    details = sessions.session_details(rows, chosen)
    assert "skew=true" in _final_plan(details)
    assert details.count() == rows.count() - 1


def test_hot_user_is_split_in_the_blacklist_join(spark, hot_rows, tiny_partitions):
    clicks = hot_rows.selectExpr(
        "timestamp'2024-01-01 00:00:00' ts", "search_keyword province", "session_id city",
        "user_id", "event_id ad_id",
    )
    listed = spark.range(100, 1100).selectExpr("id % 50 + 100 AS user_id").distinct()
    kept = ads.exclude_users(clicks, listed)
    assert "skew=true" in _final_plan(kept)
    assert kept.count() == clicks.count() - 50


def test_hot_user_is_split_in_the_profile_join(spark, tiny_partitions):
    some = spark.range(0, 20_000, 1, 16).selectExpr(
        "uuid() session_id", "if(id < 300, id, 7) AS user_id"
    )
    people = users(spark, *[(n, f"u{n}", "n", 5, "p", "c", "male") for n in range(300)])
    joined = sessions.enrich_sessions(some, people)
    assert "skew=true" in _final_plan(joined)
    assert joined.count() == 20_000
