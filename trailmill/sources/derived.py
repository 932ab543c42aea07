"""Behaviour tables derived from a generic star schema (events, customer, part, nation, region).

Used by the registered queries and the benchmark: every row of the given tables is mapped, none is
made up. Times are computed in UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import times

_WEEK = 604_800

# Declared, so that opening a table runs no job to look its columns up.
_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _event_seconds():
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return F.timestamp_diff("SECOND", epoch, F.col("ts"))


def _event_key():
    return F.get_json_object("props", "$.k").cast("bigint")


EVENT_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as they are, their times as timestamps."""
    return _read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")


def user_visit_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One action per event; ``event_id`` is kept as the tie-break of equal times, ``ts`` is the
    action time as a timestamp."""
    events = _read(spark, sf_dir, "events")
    squeeze = F.element_at(
        F.array(*[F.lit(10**n) for n in range(6)]), (F.col("user_id") % 6 + 1).cast("int")
    )
    base = events.select(
        "event_id",
        "user_id",
        "event_type",
        _event_key().alias("k"),
        _event_seconds().alias("es"),
        squeeze.cast("bigint").alias("f"),
    ).withColumn("wk", F.call_function("div", F.col("es"), F.lit(_WEEK)))
    seconds = (
        F.col("wk") * _WEEK
        + (F.col("user_id") * 3600) % 86_400
        + F.call_function("div", F.col("es") - F.col("wk") * _WEEK, F.col("f"))
    )
    k, kind = F.col("k"), F.col("event_type")
    words = F.array(*[F.lit(w) for w in ("hotpot", "cake", "noodles", "mall", "spa")])
    return base.withColumn("t", F.timestamp_seconds(seconds)).select(
        times.format_date("t").alias("date"),
        "user_id",
        F.concat(F.lit("s"), F.col("user_id"), F.lit("_"), F.col("wk")).alias("session_id"),
        (k % 10).alias("page_id"),
        F.date_format("t", times.PARSE_TIME).alias("action_time"),
        F.when(kind == "view", F.element_at(words, (k % 5 + 1).cast("int"))).alias(
            "search_keyword"
        ),
        F.when(kind == "click", k % 20).alias("click_category_id"),
        F.when(kind == "click", k).alias("click_product_id"),
        F.when(kind == "signup", F.concat_ws(",", k % 20, (k + 7) % 20)).alias(
            "order_category_ids"
        ),
        F.when(kind == "signup", k.cast("string")).alias("order_product_ids"),
        F.when(kind == "purchase", (k % 20).cast("string")).alias("pay_category_ids"),
        F.when(kind == "purchase", k.cast("string")).alias("pay_product_ids"),
        (F.col("event_id") % 25).alias("city_id"),
        "event_id",
        F.col("t").alias("ts"),
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = _read(spark, sf_dir, "customer"), _read(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("user_id"),
        F.col("c_name").alias("username"),
        F.concat(F.lit("name"), key).alias("name"),
        (key % 43 + 18).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("n_name").alias("city"),
        F.when(key % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _read(spark, sf_dir, "nation"), _read(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return _read(spark, sf_dir, "part").select(
        key.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), key % 2, F.lit("}")).alias("extend_info"),
    )


def ad_lines_of(events: DataFrame, cities: DataFrame, one_word: bool = True) -> DataFrame:
    """One log line per event; ``events`` may be a stream.

    ``one_word`` joins area names of two words with a dash; without it their lines have a field
    too many and cannot be read.
    """
    area = F.replace("area", F.lit(" "), F.lit("-")) if one_word else F.col("area")
    millis = F.timestamp_diff(
        "MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts")
    )
    # There are 25 nations at any scale, and the events are never the side to broadcast.
    located = events.join(F.broadcast(cities), F.col("event_id") % 25 == F.col("city_id"))
    return located.select(
        F.concat_ws(
            " ",
            millis,
            area,
            "city_name",
            "user_id",
            _event_key() % 10,
        ).alias("value")
    )


def ad_lines(spark: SparkSession, sf_dir: str, one_word: bool = True) -> DataFrame:
    return ad_lines_of(_read(spark, sf_dir, "events"), city_info(spark, sf_dir), one_word)


def ad_line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as a stream over the stored events."""
    # The bracket makes the path a glob, so a single file and a folder of files both stream.
    events = spark.readStream.schema(_SCHEMAS["events"]).parquet(f"{sf_dir}/events.parque[t]")
    return ad_lines_of(events, city_info(spark, sf_dir))
