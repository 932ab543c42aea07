"""Ad-click statistics. The counting operators serve batch and streaming logs alike.

Days and minutes are event-time windows, so on a stream their state can be evicted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import times
from .ranking import top_n_per_group
from .skew import fresh_layout

BLACKLIST_THRESHOLD = 15


def _windowed_counts(log: DataFrame, width: str, *keys: str) -> DataFrame:
    return log.groupBy(F.window("ts", width), *keys).agg(F.count("*").alias("click_count"))


def user_ad_daily(log: DataFrame) -> DataFrame:
    """``date, user_id, ad_id, click_count``."""
    return _windowed_counts(log, "1 day", "user_id", "ad_id").select(
        times.format_date("window.start").alias("date"), "user_id", "ad_id", "click_count"
    )


def blacklist(counts: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Distinct users with ``threshold`` or more clicks on one ad in one day."""
    return counts.where(F.col("click_count") >= threshold).select("user_id").distinct()


def exclude_users(log: DataFrame, users: DataFrame, salts: int = 1) -> DataFrame:
    """The log without the given users' clicks.

    The list is broadcast by Spark only while its size allows. Beyond that, adaptive execution
    splits a heavy user at run time. Inside a stream that help is off: ``salts`` then spreads each
    user over that many tasks of a merge join, repeating the (much smaller) list instead.
    """
    users = users.select("user_id")
    if salts == 1:
        return log.join(fresh_layout(users), "user_id", "left_anti")
    spread = users.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = log.withColumn(
        "salt", F.pmod(F.xxhash64("ts", "province", "city", "ad_id"), F.lit(salts)).cast("int")
    )
    return salted.join(spread.hint("merge"), ["user_id", "salt"], "left_anti").drop("salt")


def ad_stat(log: DataFrame) -> DataFrame:
    """``date, province, city, ad_id, click_count``."""
    return _windowed_counts(log, "1 day", "province", "city", "ad_id").select(
        times.format_date("window.start").alias("date"),
        "province",
        "city",
        "ad_id",
        "click_count",
    )


def province_ads(stat: DataFrame) -> DataFrame:
    """Clicks by ``date, province, ad_id``."""
    return stat.groupBy("date", "province", "ad_id").agg(
        F.sum("click_count").alias("click_count")
    )


def top_ads_by_province(stat: DataFrame, n: int = 3) -> DataFrame:
    """The n most clicked ads of each province and day; ties go to the smaller ad id."""
    order = [F.desc("click_count"), F.col("ad_id")]
    return top_n_per_group(province_ads(stat), ["date", "province"], order, n)


def minute_clicks(log: DataFrame) -> DataFrame:
    """``minute_start, ad_id, click_count``."""
    return _windowed_counts(log, "1 minute", "ad_id").select(
        F.col("window.start").alias("minute_start"), "ad_id", "click_count"
    )


def minute_parts(clicks: DataFrame) -> DataFrame:
    """``date, hour, minute, ad_id, click_count`` as the result table has them."""
    start = F.col("minute_start")
    return clicks.select(
        times.format_date(start).alias("date"),
        F.date_format(start, "HH").alias("hour"),
        F.date_format(start, "mm").alias("minute"),
        "ad_id",
        "click_count",
    )


def click_trend(
    log: DataFrame, lookback: str = "60 minutes", clock: DataFrame | None = None
) -> DataFrame:
    """Clicks per ad and minute over the last hour of event time.

    The last minute is that of ``clock``'s newest row (by default the log's own). It is found in a
    pass over one column, and only rows of the last hour are then counted.
    """
    newest = (log if clock is None else clock).agg(
        (F.date_trunc("minute", F.max("ts")) - F.expr(f"INTERVAL {lookback}")).alias("from_ts")
    )
    # minute > newest - lookback, said of the row's time: one minute later, inclusive.
    recent = log.where(F.col("ts") >= newest.scalar() + F.expr("INTERVAL 1 MINUTE"))
    return minute_parts(minute_clicks(recent))
