"""Scalar functions applied to every row of a given table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import jsons, numbers, text, times
from ..operators.products import area_level
from ..sources import derived
from . import inputs


def scalar_string(spark: SparkSession, folder: str) -> DataFrame:
    users = derived.user_info(spark, folder)
    packed = F.concat(
        F.lit("age="), "age", F.lit("|city="), "city", F.lit("|sex="), "sex", F.lit("|note=|")
    )
    commas = F.concat(F.lit(","), "name", F.lit(",x,"))
    return users.withColumns({"packed": packed, "commas": commas}).select(
        "user_id",
        text.get_field("packed", "age").alias("age_text"),
        text.get_field("packed", "note").alias("note"),
        text.get_field("packed", "missing").alias("missing"),
        text.set_field("packed", "city", "X").alias("packed_set"),
        text.trim_comma("commas").alias("trimmed"),
        text.pad_two((F.col("user_id") % 100).cast("string")).alias("padded"),
        text.concat_long_string("user_id", "city", ":").alias("joined"),
        text.concat_long_string("user_id", F.lit(None).cast("string"), ":").alias("joined_null"),
        text.is_empty(text.get_field("packed", "note")).alias("note_empty"),
        text.is_not_empty("city").alias("city_given"),
        F.array_join(
            text.distinct_items(F.split(F.concat_ws(",", "sex", "city", "sex"), ",")), ","
        ).alias("items"),
        F.size(text.csv_ids(F.concat_ws(",", "age", "user_id"))).alias("id_count"),
        F.element_at(text.csv_ids(F.concat_ws(",", "age", "user_id")), 2).alias("second_id"),
    )


def scalar_date(spark: SparkSession, folder: str) -> DataFrame:
    actions = derived.user_visit_action(spark, folder)
    t, fixed = times.parse_time("action_time"), F.lit("2024-01-15 9:30:00")
    return actions.select(
        "event_id",
        times.format_time(t).alias("time"),
        times.format_date(t).alias("date"),
        times.format_date_key(t).alias("date_key"),
        times.format_minute(t).alias("minute_key"),
        times.date_hour(t).alias("date_hour"),
        times.format_date(times.parse_date_key(times.format_date_key(t))).alias("key_date"),
        times.before("action_time", fixed).alias("is_before"),
        times.after("action_time", fixed).alias("is_after"),
        times.minus("action_time", fixed).alias("seconds_after"),
        times.minus("action_time", F.lit("soon")).alias("seconds_unreadable"),
        times.parse_time(F.concat(F.lit("at "), "action_time")).isNull().alias("unreadable"),
        times.format_time(times.from_epoch_ms(F.col("event_id") * 86_461_000)).alias("from_ms"),
        times.today().alias("today"),
        times.yesterday().alias("yesterday"),
    )


def scalar_number(spark: SparkSession, folder: str) -> DataFrame:
    actions = derived.user_visit_action(spark, folder)
    part, whole = F.col("event_id") % 97, F.col("event_id") % 41
    return actions.select(
        "event_id",
        numbers.ratio(part, whole).alias("ratio"),
        numbers.ratio(part, whole, 3).alias("ratio_3"),
        numbers.format_double(part / F.lit(8.0), 1).alias("rounded"),
        numbers.format_double(F.lit(float("nan")), 2).alias("not_a_number"),
    )


def scalar_json(spark: SparkSession, folder: str) -> DataFrame:
    products = derived.product_info(spark, folder)
    cut = F.substring("extend_info", 1, 12)
    task = F.concat(F.lit('{"sex": ["'), "product_name", F.lit('", "b"], "cities": []}'))
    return products.select(
        "product_id",
        jsons.json_field("extend_info", "product_status").alias("status"),
        jsons.json_field("extend_info", "colour").alias("missing"),
        jsons.json_field(cut, "product_status").alias("malformed"),
        jsons.product_status("extend_info").alias("seller"),
        jsons.product_status(cut).alias("seller_malformed"),
        jsons.task_param(task, "sex").alias("param"),
        jsons.task_param(task, "cities").alias("param_empty"),
        jsons.task_param(task, "keywords").alias("param_absent"),
    )


def scalar_area_level(spark: SparkSession, folder: str) -> DataFrame:
    """The level of every city's area, by the default names and by the names in use here."""
    cities = derived.city_info(spark, folder)
    # An area name of each default level.
    named = F.element_at(
        F.array(*[F.lit(a) for a in ("华北", "华东", "华南", "华中", "西北", "西南", "东北")]),
        F.col("city_id") % 7 + 1,
    )
    return cities.select(
        "city_id",
        area_level(named).alias("default_level"),
        area_level(F.col("area"), inputs.AREA_LEVELS, inputs.OTHER_LEVEL).alias("level"),
    )


_ALL = (scalar_string, scalar_date, scalar_number, scalar_json, scalar_area_level)
QUERIES = {query.__name__: inputs.in_utc(query) for query in _ALL}
