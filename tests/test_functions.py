from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trailmill.functions import jsons, numbers, sql, text, times


def _one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "value, empty", [(None, True), ("", True), (" ", False), ("a", False)]
)
def test_is_empty(spark, value, empty):
    assert _one(spark, value, text.is_empty) is empty
    assert _one(spark, value, text.is_not_empty) is not empty


@pytest.mark.parametrize(
    "value, trimmed",
    [(",a,b,", "a,b"), ("a,", "a"), (",a", "a"), (",,a,,", ",a,"), (",", ""), ("", "")],
)
def test_trim_comma(spark, value, trimmed):
    assert _one(spark, value, text.trim_comma) == trimmed


@pytest.mark.parametrize("value, padded", [("5", "05"), ("12", "12"), ("", "0"), ("123", "0123")])
def test_pad_two(spark, value, padded):
    assert _one(spark, value, text.pad_two) == padded


PACKED = "age=30|words=|city=a.b|x=1=2|age=40|tail=z="


@pytest.mark.parametrize(
    "field, value",
    [("age", "30"), ("words", None), ("city", "a.b"), ("x", None), ("tail", "z"), ("none", None), ("ity", None)],
)
def test_get_field(spark, field, value):
    assert _one(spark, PACKED, lambda c: text.get_field(c, field)) == value


def test_get_field_with_another_delimiter(spark):
    assert _one(spark, "a=1;b=2", lambda c: text.get_field(c, "b", ";")) == "2"


@pytest.mark.parametrize(
    "field, packed",
    [
        ("age", "age=9|words=|city=a.b|x=1=2|age=40|tail=z="),
        ("x", "age=30|words=|city=a.b|x=9|age=40|tail=z="),
        ("none", PACKED),
    ],
)
def test_set_field(spark, field, packed):
    assert _one(spark, PACKED, lambda c: text.set_field(c, field, "9")) == packed


def test_set_field_writes_a_missing_value_as_null(spark):
    assert _one(spark, "a=1|b=2", lambda c: text.set_field(c, "a", F.lit(None).cast("string"))) == "a=null|b=2"


def test_set_field_drops_empty_tail(spark):
    assert _one(spark, "a=1|b=2||", lambda c: text.set_field(c, "b", F.lit("$1"))) == "a=1|b=$1"


def test_csv_ids(spark):
    assert _one(spark, "3,17,x,", text.csv_ids) == [3, 17, None, None]


def test_concat_long_string(spark):
    assert _one(spark, 7, lambda c: text.concat_long_string(c, F.lit("a"), ":"), "long") == "7:a"
    null = F.lit(None).cast("string")
    assert _one(spark, 7, lambda c: text.concat_long_string(c, null, ":"), "long") == "7:null"


def test_group_concat_distinct_skips_null(spark):
    df = spark.createDataFrame([("11:a",), ("1:a",), (None,), ("1:a",)], "v string")
    assert df.agg(text.group_concat_distinct("v").alias("r")).first().r == "11:a,1:a"
    none = spark.createDataFrame([(None,)], "v string")
    assert none.agg(text.group_concat_distinct("v").alias("r")).first().r == ""


def test_distinct_items(spark):
    assert _one(spark, "12,1,12", lambda c: text.distinct_items(F.split(c, ","))) == ["12", "1"]


@pytest.mark.parametrize(
    "value, time",
    [
        ("2019-04-21 3:05:07", "2019-04-21 03:05:07"),
        ("2019-04-21 13:05:07", "2019-04-21 13:05:07"),
        ("yesterday", None),
        (None, None),
    ],
)
def test_parse_time(spark, value, time):
    assert _one(spark, value, lambda c: times.format_time(times.parse_time(c))) == time


def test_order_of_times(spark):
    early, late = "2019-04-21 9:00:00", "2019-04-21 10:00:00"
    assert _one(spark, early, lambda c: times.before(c, F.lit(late))) is True
    assert _one(spark, early, lambda c: times.after(c, F.lit(late))) is False
    assert _one(spark, "bad", lambda c: times.before(c, F.lit(late))) is False
    assert _one(spark, late, lambda c: times.minus(c, F.lit(early))) == 3600
    assert _one(spark, early, lambda c: times.minus(c, F.lit(late))) == -3600
    assert _one(spark, "bad", lambda c: times.minus(c, F.lit(late))) == 0


def test_date_formats(spark):
    def at(fn):
        return _one(spark, "2019-04-21 3:05:07", lambda c: fn(times.parse_time(c)))

    assert at(times.format_date) == "2019-04-21"
    assert at(times.format_date_key) == "20190421"
    assert at(times.format_minute) == "201904210305"
    assert at(times.date_hour) == "2019-04-21_03"
    assert str(_one(spark, "20190421", times.parse_date_key)) == "2019-04-21"
    assert _one(spark, "2019-", times.parse_date_key) is None
    ms = _one(spark, 1_555_815_907_123, lambda c: times.format_time(times.from_epoch_ms(c)), "long")
    assert ms == "2019-04-21 03:05:07"


@pytest.mark.parametrize(
    "part, whole, scale, value",
    [
        (1, 3, 2, 0.33),
        (2, 3, 2, 0.67),
        (29, 200, 2, 0.15),
        (1, 200, 2, 0.01),
        (5, 0, 2, 0.0),
        (0, 0, 2, 0.0),
        (3, 2, 0, 2.0),
        (2**40, 2**41, 2, 0.5),
    ],
)
def test_ratio(spark, part, whole, scale, value):
    df = spark.createDataFrame([(part, whole)], "p long, w long")
    assert df.select(numbers.ratio("p", "w", scale).alias("r")).first().r == value
    if scale == 2:
        sql.register(spark)
        assert spark.sql(f"select half_up_ratio({part}, {whole}) r").first().r == value


def test_format_double(spark):
    assert _one(spark, float("nan"), lambda c: numbers.format_double(c, 2), "double") == 0.0
    assert _one(spark, 2.345, lambda c: numbers.format_double(c, 1), "double") == 2.3


@pytest.mark.parametrize(
    "value, field",
    [('{"a": 0}', "0"), ('{"a": "x"}', "x"), ('{"b": 1}', None), ('{"a"', None), (None, None)],
)
def test_json_field(spark, value, field):
    assert _one(spark, value, lambda c: jsons.json_field(c, "a")) == field


def test_task_param(spark):
    doc = '{"sex": ["male"], "cities": [], "ages": null}'
    assert _one(spark, doc, lambda c: jsons.task_param(c, "sex")) == "male"
    assert _one(spark, doc, lambda c: jsons.task_param(c, "cities")) is None
    assert _one(spark, doc, lambda c: jsons.task_param(c, "none")) is None


def test_sql_functions(spark):
    sql.register(spark)
    sql.register(spark)
    row = spark.sql(
        """SELECT concat_long_string(3, NULL, '-') a, trim_comma(',x,') b,
                  json_field('{"k": {"z": 1}}', 'k') c"""
    ).first()
    assert tuple(row) == ("3-null", "x", '{"z":1}')
