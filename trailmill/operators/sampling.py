"""Proportional sample of sessions: equal share per day, by hour within a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import times
from .ranking import top_n_per_group


def with_start_hour(sessions: DataFrame) -> DataFrame:
    return sessions.withColumns(
        {"date": times.format_date("start_time"), "hour": F.date_format("start_time", "HH")}
    )


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """``date, hour, session_count, day_count``."""
    hours = with_start_hour(sessions).groupBy("date", "hour").agg(
        F.count("*").alias("session_count")
    )
    day = Window.partitionBy("date")
    return hours.withColumn("day_count", F.sum("session_count").over(day))


def sample_quotas(hours: DataFrame, total: int = 100) -> DataFrame:
    """``date, hour, session_count, day_count, quota``.

    ``total`` is shared equally among the days that have sessions (whole division); a day's share
    goes to its hours in proportion, rounded down, and never exceeds what an hour has.

    ``hours`` has at most 24 rows per day whatever the number of sessions, so counting its days
    in one window is cheap.
    """
    first_of_day = F.row_number().over(Window.partitionBy("date").orderBy("hour")) == 1
    days = F.count_if(F.col("first")).over(Window.partitionBy())
    share = F.call_function("div", F.lit(total).cast("bigint"), F.col("days"))
    quota = F.call_function("div", F.col("session_count") * share, F.col("day_count"))
    counted = hours.withColumn("first", first_of_day).withColumn("days", days)
    return counted.select(
        "date",
        "hour",
        "session_count",
        "day_count",
        F.least(quota, F.col("session_count")).alias("quota"),
    )


def sample_sessions(sessions: DataFrame, total: int = 100, seed: int = 0) -> DataFrame:
    """The sampled sessions, all columns, plus ``date, hour``.

    Order within an hour is a seeded hash of the session id, so a rerun, another partitioning or a
    lost executor draws the same sessions. Every quota is at most ``total``, so only the first
    ``total`` sessions of an hour can be drawn: that constant bound trims a crowded hour before the
    shuffle, and the quota then decides.
    """
    quotas = sample_quotas(sessions_per_hour(sessions), total).select("date", "hour", "quota")
    draw = F.md5(F.concat(F.col("session_id"), F.lit(f"#{seed}")))
    drawn = top_n_per_group(
        with_start_hour(sessions), ["date", "hour"], [draw, F.col("session_id")], total, "__draw"
    )
    kept = drawn.join(quotas, ["date", "hour"]).where(F.col("__draw") <= F.col("quota"))
    return kept.drop("__draw", "quota")


def sample_details(details: DataFrame, sample: DataFrame) -> DataFrame:
    """Every action of the sampled sessions. A sample has at most ``total`` rows: broadcast."""
    return details.join(F.broadcast(sample.select("session_id")), "session_id", "left_semi")
