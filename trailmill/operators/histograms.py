"""Distribution of sessions over visit lengths and step lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import numbers
from ..schemas import STEP_LENGTH_BUCKETS, VISIT_LENGTH_BUCKETS
from .observed import Watch


def _in_bucket(value: Column, low: int, high: int | None) -> Column:
    return value >= low if high is None else value.between(low, high)


def _counts() -> list[Column]:
    buckets = [
        F.count_if(_in_bucket(F.col(column), low, high)).alias(name)
        for column, table in (
            ("visit_length", VISIT_LENGTH_BUCKETS),
            ("step_length", STEP_LENGTH_BUCKETS),
        )
        for name, (low, high) in table.items()
    ]
    return [F.count(F.lit(1)).alias("session_count"), *buckets]


def session_histogram(sessions: DataFrame) -> DataFrame:
    """One row: ``session_count`` and a count per bucket.

    A plain aggregate (one pass, a few longs shuffled), so a retried task never counts twice.
    A session of 0 seconds is in no visit-length bucket.
    """
    return sessions.agg(*_counts())


def observe_histogram(sessions: DataFrame, watch: Watch) -> DataFrame:
    """The sessions, whose histogram is taken as they pass, in whatever job reads them."""
    return watch.see("histogram", sessions, *_counts())


def observed_histogram(spark: SparkSession, watch: Watch) -> DataFrame:
    """:func:`session_histogram` of the sessions that passed."""
    got = watch.got("histogram")
    return spark.createDataFrame([tuple(got.values())], ", ".join(f"`{name}` bigint" for name in got))


def session_ratios(histogram: DataFrame, scale: int = 2) -> DataFrame:
    """Each bucket's share of all sessions, rounded half up."""
    return histogram.select(
        "session_count",
        *[
            numbers.ratio(F.col(name), F.col("session_count"), scale).alias(name)
            for name in (*VISIT_LENGTH_BUCKETS, *STEP_LENGTH_BUCKETS)
        ],
    )
