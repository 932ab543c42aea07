"""Category counts, the top categories, and the most active sessions in each."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text
from .ranking import top_n_per_group


def _one(column: str):
    return F.when(F.col(column).isNotNull(), F.array(F.col(column))).otherwise(
        F.array().cast("array<bigint>")
    )


def _many(column: str):
    return F.coalesce(text.csv_ids(column), F.array().cast("array<bigint>"))


def visited_categories(details: DataFrame) -> DataFrame:
    """Distinct categories clicked, ordered or paid."""
    ids = F.concat(
        _one("click_category_id"), _many("order_category_ids"), _many("pay_category_ids")
    )
    return (
        details.select(F.explode(ids).alias("category_id"))
        .where(F.col("category_id").isNotNull())
        .distinct()
    )


def category_counts(details: DataFrame) -> DataFrame:
    """``category_id, click_count, order_count, pay_count``: one pass over the actions.

    Each action becomes (category, kind) events that are summed on the map side, so only one row
    per category and task is shuffled.
    """
    touched = details.select(
        F.explode(
            F.array(
                F.struct(F.lit("click").alias("kind"), _one("click_category_id").alias("ids")),
                F.struct(F.lit("order").alias("kind"), _many("order_category_ids").alias("ids")),
                F.struct(F.lit("pay").alias("kind"), _many("pay_category_ids").alias("ids")),
            )
        ).alias("act")
    ).select("act.kind", F.explode("act.ids").alias("category_id"))
    return (
        touched.where(F.col("category_id").isNotNull())
        .groupBy("category_id")
        .agg(
            *[
                F.count_if(F.col("kind") == kind).alias(f"{kind}_count")
                for kind in ("click", "order", "pay")
            ]
        )
    )


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """The n first by clicks, then orders, then payments; ties go to the smaller id."""
    order = [F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), "category_id"]
    return counts.orderBy(*order).limit(n)


def category_session_clicks(details: DataFrame) -> DataFrame:
    """``category_id, session_id, click_count``."""
    clicks = details.where(F.col("click_category_id").isNotNull())
    return clicks.groupBy(F.col("click_category_id").alias("category_id"), "session_id").agg(
        F.count("*").alias("click_count")
    )


def top_sessions_by_category(details: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    """The n sessions with most clicks in each top category: ``category_id, session_id,
    click_count, rank``.

    ``top`` is a top-n result, a handful of rows by construction, so broadcasting it is safe; the
    join then drops clicks on other categories before they are counted or shuffled.
    """
    wanted = F.broadcast(top.select(F.col("category_id").alias("click_category_id")))
    clicks = category_session_clicks(details.join(wanted, "click_category_id", "left_semi"))
    order = [F.desc("click_count"), F.col("session_id")]
    return top_n_per_group(clicks, ["category_id"], order, n)


def top_session_details(details: DataFrame, top_sessions: DataFrame) -> DataFrame:
    """Every action of the top sessions, once per category a session is top in.

    ``top_sessions`` holds at most n sessions for each of n categories: broadcast.
    """
    wanted = F.broadcast(top_sessions.select("category_id", "session_id"))
    return details.join(wanted, "session_id")
