"""Bloom filters, observed counts, and filters of many tasks."""

from __future__ import annotations

import pytest
from fixtures import tuples
from test_plans import _final_plan, tiny_partitions  # noqa: F401 - a fixture

from pyspark.sql import functions as F

import __spark_entry__ as entry
from trailmill.catalog import batch, inputs
from trailmill.operators import bloom, observed, sessions, tasks
from trailmill.params import JobParams

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("count", [1, 30, 3000])
def test_a_filter_holds_its_keys_and_little_else(spark, count):
    keys = spark.range(count).selectExpr("concat('s', id) AS k").unionByName(spark.createDataFrame([(None,)], "k string"))
    bits = bloom.bits_for(count)
    rows = spark.range(-20_000, 20_000).selectExpr("concat('s', id) AS k", "id")
    words = bloom.words_of(keys, "k", bits)
    assert len(words.first()["words"]) == bits // 64
    passed = rows.where(bloom.may_hold(words.scalar(), F.col("k"), bits))
    ids = {r.id for r in passed.collect()}
    assert ids >= set(range(count))
    assert len(ids) - count <= 0.03 * 40_000
    nulls = spark.createDataFrame([(None,)], "k string")
    assert nulls.where(bloom.may_hold(words.scalar(), F.col("k"), bits)).count() == 0


def test_no_keys_pass_nothing(spark):
    rows = spark.range(100).selectExpr("concat('s', id) AS k")
    assert bloom.pruned(rows, rows.where("false"), "k", 0, always=True).count() == 0


def test_a_short_list_is_left_to_the_broadcast_and_a_huge_one_to_the_join(spark):
    rows = spark.range(10).selectExpr("concat('s', id) AS k")
    assert bloom.pruned(rows, rows, "k", 10) is rows
    assert bloom.pruned(rows, rows, "k", 20_000_000, always=True) is rows


def test_the_filter_stands_between_the_scan_and_the_shuffle(spark, tmp_path, tiny_partitions):  # noqa: F811
    spark.range(0, 40_000, 1, 4).selectExpr("concat('s', id % 2000) AS session_id", "id AS page_id").write.parquet(f"{tmp_path}/a")
    spark.range(100).selectExpr("concat('s', id) AS session_id").write.parquet(f"{tmp_path}/s")
    actions, chosen = spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/s")
    details = sessions.session_details(actions, chosen, chosen.count())
    plain = sessions.session_details(actions, chosen)
    assert tuples(details, "session_id", "page_id") == tuples(plain, "session_id", "page_id")
    text = _final_plan(details)
    final = text[: text.index("Initial Plan")]
    assert "bit_get" in final and "bit_get" not in _final_plan(plain)
    # Of the actions, what passes is shuffled: 2000 rows of sessions that are chosen and about a hundredth of the others.
    shuffled = actions.where(
        bloom.may_hold(bloom.words_of(chosen, "session_id", bloom.bits_for(100)).scalar(), F.col("session_id"), bloom.bits_for(100))
    ).count()
    assert 2000 <= shuffled <= 2000 + 0.04 * 38_000


def test_one_scan_counts_every_stage(spark):
    seen = observed.Watch()
    acted = seen.count("actions", inputs.actions(spark, FOLDER))
    few = seen.count("few", acted.where("page_id < 3"))
    assert few.explain is not None
    observed.run(few)
    assert tuples(seen.counts(spark), "stage", "n") == sorted(
        [("actions", acted.count()), ("few", acted.where("page_id < 3").count())]
    )
    text = _final_plan(seen.count("again", inputs.actions(spark, FOLDER)))
    assert text.count("FileScan") == text.count("Initial Plan") + 1 or text.count("FileScan") == 1


def test_stages_left_out_of_an_empty_plan_are_counted(spark):
    seen = observed.Watch()
    rows = seen.count("rows", spark.range(7).withColumn("k", F.col("id") % 2))
    none = seen.count("none", rows.join(spark.range(3).where("id > 5").withColumnRenamed("id", "k"), "k"))
    observed.run(none)
    assert tuples(seen.counts(spark), "stage", "n") == [("none", 0), ("rows", 7)]


def test_row_counts_scan_the_events_once(spark, monkeypatch):
    ran = []
    monkeypatch.setattr(observed, "run", lambda rows: (ran.append(rows), rows.write.format("noop").mode("overwrite").save()))
    got = entry.queries()["row_counts"](spark, FOLDER)
    assert len(ran) == 1 and got.count() == 3
    text = ran[0]._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("event_id") >= 1
    assert ran[0]._jdf.queryExecution().sparkPlan().toString().count("events.parquet") == 1


def test_filters_of_tasks_are_those_of_each_task_alone(spark):
    enriched = inputs.enriched(spark, FOLDER)
    asked = [*batch.TASKS, (4, None), (5, "not json"), (6, '{"cities": [""], "sex": ["male,female"], "endAge": ["30"]}'), (7, '{"keywords": ["nothing"]}')]
    table = spark.createDataFrame(asked, "task_id bigint, task_param string")
    got = tuples(tasks.filter_by_task(enriched, table), "task_id", "session_id")
    wanted = []
    for task, text in asked:
        alone = sessions.filter_sessions(enriched, JobParams.from_task(task, text if text and text[0] == "{" else "{}").sessions)
        wanted += [(task, r.session_id) for r in alone.select("session_id").collect()]
    assert got == sorted(wanted)
    assert tasks.filter_by_task(enriched, table.where("false")).count() == 0


def test_tasks_share_one_scan(spark):
    df = entry.queries()["session_filtered_by_task"](spark, FOLDER)
    assert df._jdf.queryExecution().sparkPlan().toString().count("events.parquet") == 1
