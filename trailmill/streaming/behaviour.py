"""Streams of user behaviour: sessions that merge as events arrive, and views followed by clicks.

Both keep what is still open in Spark's state store and let the watermark evict it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from .adclicks import EVERY_5_SECONDS, AdTables, start


def user_sessions(log: DataFrame, gap: str) -> DataFrame:
    """``user_id, start_time, end_time, click_count``: a user's clicks with less than ``gap`` between neighbours.

    In a stream a session is open, and a late click may join two into one, until the watermark is a gap behind its last
    click; then it is given out once. A session's clicks are counted before they are shuffled.
    """
    return (
        log.groupBy(F.session_window("ts", gap), "user_id")
        .agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time"), F.count("*").alias("click_count"))
        .select("user_id", "start_time", "end_time", "click_count")
    )


def start_session_query(
    log: DataFrame, tables: AdTables, gap: str = "30 minutes", watermark: str = "1 day", trigger: dict = EVERY_5_SECONDS
) -> StreamingQuery:
    """Store the sessions in ``tables.sessions`` as they end."""

    def save(batch: DataFrame, batch_id: int) -> None:
        tables.sessions.publish(batch.withColumn("date", F.date_format("end_time", "yyyy-MM-dd")), batch_id)

    sessions = user_sessions(log.withWatermark("ts", watermark), gap)
    return start(sessions, "sessions", tables, save, trigger, mode="append")


def _bucket(ts: Column, seconds: int) -> Column:
    return F.call_function("div", F.unix_micros(ts), F.lit(seconds * 1_000_000))


def views_to_clicks(views: DataFrame, clicks: DataFrame, within_seconds: int) -> DataFrame:
    """``user_id, view_id, click_id, wait_ms``: every click of a user within so many seconds after one of their views.

    ``views`` and ``clicks`` have ``event_id, ts, user_id``. In streams both need a watermark: a view is kept until no click
    can follow it in time, a click until no view before it can still arrive.

    The keys are the user and a slice of time as long as the wait, a view standing in its own slice and the next one,
    so a user with a third of all events is dealt over the slices instead of one task.
    """
    slice_ = _bucket(F.col("ts"), within_seconds)
    seen = views.select(
        F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"), F.col("user_id"),
        F.explode(F.array(slice_, slice_ + 1)).alias("slice"),
    )
    clicked = clicks.select(
        F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"), F.col("user_id").alias("click_user"),
        slice_.alias("click_slice"),
    )
    wait = F.expr(f"INTERVAL {within_seconds} SECONDS")
    met = seen.join(
        clicked,
        (F.col("user_id") == F.col("click_user"))
        & (F.col("slice") == F.col("click_slice"))
        & (F.col("click_ts") >= F.col("view_ts"))
        & (F.col("click_ts") <= F.col("view_ts") + wait),
    )
    waited = F.unix_millis("click_ts") - F.unix_millis("view_ts")
    return met.select("user_id", "view_id", "click_id", waited.alias("wait_ms"), "view_ts")


def start_view_click_query(
    views: DataFrame,
    clicks: DataFrame,
    tables: AdTables,
    within_seconds: int = 3600,
    watermark: str = "1 day",
    trigger: dict = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Store the views followed by clicks in ``tables.view_clicks``, by the view's day."""

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("date", F.date_format("view_ts", "yyyy-MM-dd"))
        tables.view_clicks.publish(rows, batch_id)

    late = [side.withWatermark("ts", watermark) for side in (views, clicks)]
    return start(views_to_clicks(*late, within_seconds), "view_clicks", tables, save, trigger, mode="append")
