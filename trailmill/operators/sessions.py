"""Sessions: roll-up of actions, user attributes, filter, detail."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions import times
from ..params import SessionFilter
from ..sources.tables import with_event_time
from . import bloom
from .skew import fresh_layout


def session_rollup(actions: DataFrame) -> DataFrame:
    """One row per session.

    ``session_id, user_id, start_time, end_time, visit_length`` (whole seconds), ``step_length``
    (actions), ``search_keywords`` and ``click_category_ids`` (sorted distinct arrays).

    Two steps. The first counts by session, keyword and category with fixed-width buffers, so it
    stays in the generated hash aggregate and a session holding a third of all rows shrinks to its
    distinct values before the shuffle. The second only meets those.
    """
    actions = with_event_time(actions)
    keyword = F.when(F.col("search_keyword") != "", F.col("search_keyword"))
    seen = actions.groupBy(
        "session_id",
        keyword.alias("keyword"),
        F.col("click_category_id").alias("category_id"),
    ).agg(
        F.max("user_id").alias("user_id"),
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
        F.count("*").alias("steps"),
    )
    sessions = seen.groupBy("session_id").agg(
        F.max("user_id").alias("user_id"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.sum("steps").alias("step_length"),
        F.array_sort(F.collect_set("keyword")).alias("search_keywords"),
        F.array_sort(F.collect_set("category_id")).alias("click_category_ids"),
    )
    return sessions.select(
        "session_id",
        "user_id",
        "start_time",
        "end_time",
        times.seconds_between("start_time", "end_time").alias("visit_length"),
        "step_length",
        "search_keywords",
        "click_category_ids",
    )


def enrich_sessions(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Add ``age, professional, city, sex``; a session without a known user is dropped.

    No broadcast hint: the user table grows with the shop. Spark broadcasts it while its measured
    size allows and otherwise joins by shuffle, splitting heavy users (adaptive skew join).
    """
    attributes = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(attributes, "user_id", "inner")


# The predicates below are NULL, hence not true, for a missing value. They are left bare so that
# they can be pushed into the scan of the users.
def between(value: Column, low: int | None, high: int | None) -> Column | None:
    """Inclusive range, applied only if both bounds are given."""
    return None if low is None or high is None else value.between(low, high)


def one_of(value: Column, allowed: Iterable | None) -> Column | None:
    """Scalar membership; no list passes everything."""
    return None if allowed is None else value.isin(*allowed)


def any_of(values: Column, allowed: Iterable | None, kind: str) -> Column | None:
    """Whether an array column shares a value with the list; an empty array does not."""
    if allowed is None:
        return None
    wanted = F.array(*[F.lit(item) for item in allowed]).cast(f"array<{kind}>")
    return F.arrays_overlap(values, wanted)


def equal(value: Column, wanted) -> Column | None:
    """Equality; no wanted value passes everything."""
    return None if wanted is None else value == F.lit(wanted)


def session_predicates(f: SessionFilter) -> dict[str, Column]:
    """The predicates ``f`` asks for, by name."""
    asked = {
        "age": between(F.col("age"), f.start_age, f.end_age),
        "professional": one_of(F.col("professional"), f.professionals),
        "city": one_of(F.col("city"), f.cities),
        "sex": one_of(F.col("sex"), f.sex),
        "keywords": any_of(F.col("search_keywords"), f.keywords, "string"),
        "categories": any_of(F.col("click_category_ids"), f.category_ids, "bigint"),
    }
    return {name: test for name, test in asked.items() if test is not None}


def filter_sessions(sessions: DataFrame, f: SessionFilter) -> DataFrame:
    """Sessions passing every given predicate.

    One ``where``: Catalyst sends the user predicates below the join to the user scan.
    """
    tests = session_predicates(f).values()
    return sessions.where(reduce(lambda a, b: a & b, tests)) if tests else sessions


def session_details(
    actions: DataFrame, sessions: DataFrame, count: int | None = None, always: bool = False
) -> DataFrame:
    """Every action of the given sessions (action columns only, so a semi join).

    With ``count``, the number of sessions, most actions of other sessions are dropped by a Bloom filter before they are
    shuffled (:func:`.bloom.pruned`); ``sessions`` should then be a stored table.
    """
    if count is not None:
        actions = bloom.pruned(actions, sessions, "session_id", count, always)
    chosen = fresh_layout(sessions.select("session_id"))
    return actions.join(chosen, "session_id", "left_semi")


def detail_rows(details: DataFrame, task_id: int, *extra: str) -> DataFrame:
    """Details in the layout of the result table; absent ids stay NULL."""
    columns = [name for name in schemas.SESSION_DETAIL.names if name != "task_id"]
    return details.select(F.lit(task_id).cast("bigint").alias("task_id"), *extra, *columns)


def session_text(sessions: DataFrame) -> DataFrame:
    """Lists as comma-joined text and times as text, the layout of the result tables."""
    changed = {
        "start_time": times.format_time("start_time"),
        "end_time": times.format_time("end_time"),
        "search_keywords": F.array_join("search_keywords", ","),
        "click_category_ids": F.array_join(
            F.col("click_category_ids").cast("array<string>"), ","
        ),
    }
    return sessions.withColumns({c: e for c, e in changed.items() if c in sessions.columns})
