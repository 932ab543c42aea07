from __future__ import annotations

import json

import pytest
from fixtures import actions, at, tuples, users

from trailmill import schemas
from trailmill.params import ParameterError
from trailmill.plans import jobs, reports
from trailmill.sources import adlog, jdbc


@pytest.fixture
def stored(spark, tmp_path):
    acted = actions(
        spark,
        {"action_time": at(1), "page_id": 1, "search_keyword": "cake", "city_id": 1},
        {"action_time": at(3), "page_id": 2, "click_category_id": 5, "click_product_id": 8, "city_id": 1},
        {"action_time": at(4), "page_id": 3, "order_category_ids": "5,6", "city_id": 1},
        with_id=False,
    )
    acted.write.parquet(f"{tmp_path}/actions")
    users(spark, (1, "u", "n", 30, "p", "c", "male")).write.parquet(f"{tmp_path}/users")
    spark.createDataFrame([(8, "prod", '{"product_status": 0}')], schemas.PRODUCT_INFO).write.parquet(
        f"{tmp_path}/products"
    )
    spark.createDataFrame([(1, "rome", "华东")], schemas.CITY_INFO).write.parquet(f"{tmp_path}/cities")
    return tmp_path


def _run(spark, stored, job, params, *more):
    args = [job, "--task-id", "3", "--params", json.dumps(params)]
    args += ["--actions", f"{stored}/actions", "--out", f"{stored}/out", *more]
    jobs.main(args, spark)

    def result(name, schema):
        return reports.read_result(spark, f"{stored}/out", name, schema)

    return result


def test_session_job(spark, stored):
    result = _run(
        spark, stored, "session", {"startAge": ["20"], "endAge": ["40"]}, "--users", f"{stored}/users"
    )
    row = result("session_aggr_stat", schemas.SESSION_AGGR_STAT).first()
    assert (row.task_id, row.session_count, row["1s_3s"], row["1_3"]) == (3, 1, 1.0, 1.0)
    got = result("top10_category", schemas.TOP10_CATEGORY)
    assert tuples(got, "category_id", "click_count", "order_count", "pay_count") == [
        (5, 1, 1, 0),
        (6, 0, 1, 0),
    ]
    got = result("top10_category_session", schemas.TOP10_CATEGORY_SESSION)
    assert tuples(got, "category_id", "session_id", "click_count") == [(5, "s1", 1)]
    assert result("top10_session_detail", schemas.SESSION_DETAIL).count() == 3
    got = result("session_random_extract", schemas.SESSION_RANDOM_EXTRACT)
    assert tuples(got, "session_id", "start_time", "search_keywords", "click_category_ids") == [
        ("s1", "2019-04-21 00:00:01", "cake", "5")
    ]


def test_page_job(spark, stored):
    result = _run(spark, stored, "page", {"targetPageFlow": ["1,2,3"]})
    got = result("page_split_convert_rate", schemas.PAGE_SPLIT_CONVERT_RATE)
    assert tuples(got, "task_id", "convert_rate") == [(3, "1_2=1.0|2_3=1.0")]
    with pytest.raises(ParameterError):
        _run(spark, stored, "page", {})


def test_product_job(spark, stored):
    result = _run(
        spark, stored, "product", {"startDate": ["2019-04-21"]},
        "--products", f"{stored}/products", "--cities", f"{stored}/cities",
    )
    got = result("area_top3_product", schemas.AREA_TOP3_PRODUCT)
    assert tuples(got, *schemas.AREA_TOP3_PRODUCT.names) == [
        (3, "华东", "A级", 8, "1:rome", 1, "prod", "Self")
    ]


def test_a_task_without_matches_replaces_its_earlier_rows(spark, stored):
    more = ("--users", f"{stored}/users")
    for params in ({"startAge": ["90"], "endAge": ["99"]}, {"startAge": ["20"]}, {"startDate": ["2030-01-01"]}):
        result = _run(spark, stored, "session", params, *more)
        found = {name: result(name, schema).count() for name, schema in reports.SESSION_RESULTS.items()}
        if params == {"startAge": ["20"]}:
            assert all(found.values()), found
        else:
            assert found.pop("session_aggr_stat") <= 1 and not any(found.values()), found


def test_a_product_task_without_clicks_replaces_its_earlier_rows(spark, stored):
    more = ("--products", f"{stored}/products", "--cities", f"{stored}/cities")
    for start, expected in (("2030-01-01", 0), ("2019-04-21", 1), ("2030-01-01", 0)):
        result = _run(spark, stored, "product", {"startDate": [start]}, *more)
        assert result("area_top3_product", schemas.AREA_TOP3_PRODUCT).count() == expected


def test_other_tasks_keep_their_rows(spark, stored):
    more = ("--products", f"{stored}/products", "--cities", f"{stored}/cities")
    _run(spark, stored, "product", {"startDate": ["2019-04-21"]}, *more)
    args = ["product", "--task-id", "4", "--params", json.dumps({"startDate": ["2030-01-01"]})]
    jobs.main([*args, "--actions", f"{stored}/actions", "--out", f"{stored}/out", *more], spark)
    got = reports.read_result(spark, f"{stored}/out", "area_top3_product", schemas.AREA_TOP3_PRODUCT)
    assert tuples(got, "task_id") == [(3,)]


def test_options_reach_the_sources(spark, stored, monkeypatch):
    read, written, streamed = {}, {}, {}
    cities = spark.read.parquet(f"{stored}/cities")
    monkeypatch.setattr(jdbc, "read_jdbc", lambda spark, url, table, **o: read.update(o, url=url) or cities)
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, url, table, **o: written.update({table: (df.count(), url, o)}))
    _run(
        spark, stored, "product", {}, "--products", f"{stored}/products", "--jdbc-url", "jdbc:in", "--out-jdbc-url", "jdbc:out",
        "--jdbc-option", "user=me", "--jdbc-option", "password=a=b",
    )
    assert read == {"url": "jdbc:in", "user": "me", "password": "a=b"}
    assert written == {"area_top3_product": (1, "jdbc:out", {"user": "me", "password": "a=b"})}

    def lines(spark, brokers, topics, starting, **options):
        streamed.update(options, starting=starting)
        raise InterruptedError

    monkeypatch.setattr(adlog, "kafka_lines", lines)
    with pytest.raises(InterruptedError):
        jobs.main(["ads", "--brokers", "b", "--topics", "t", "--out", "o", "--starting", "latest", "--kafka-option", "maxOffsetsPerTrigger=9"], spark)
    assert streamed == {"starting": "latest", "maxOffsetsPerTrigger": "9"}
