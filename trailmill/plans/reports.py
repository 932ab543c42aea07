"""The three batch reports. Each reads behaviour tables and fills result tables under a folder.

Results are stored by ``task_id``; running a task again replaces its own rows and no others. What
several results need is written once and read back: a stored table survives lost executors, and
unlike a cache it does not compete with the shuffles for memory.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators import categories, funnel, histograms, products, sampling, sessions
from ..params import JobParams, ParameterError
from ..sinks.tables import read_slices
from ..sources import tables

SESSION_RESULTS = {
    "session_aggr_stat": schemas.SESSION_AGGR_STAT,
    "session_random_extract": schemas.SESSION_RANDOM_EXTRACT,
    "session_sample_detail": schemas.SESSION_DETAIL,
    "top10_category": schemas.TOP10_CATEGORY,
    "top10_category_session": schemas.TOP10_CATEGORY_SESSION,
    "top10_session_detail": schemas.SESSION_DETAIL,
}


# The result tables of each job.
RESULTS = {
    "session": SESSION_RESULTS,
    "page": {"page_split_convert_rate": schemas.PAGE_SPLIT_CONVERT_RATE},
    "product": {"area_top3_product": schemas.AREA_TOP3_PRODUCT},
}


def _store(df: DataFrame, out: str, name: str, task_id: int) -> None:
    """Replace the task's rows. Its folder is written even if there are none: the earlier rows go."""
    df.drop("task_id").write.mode("overwrite").parquet(f"{out}/{name}/task_id={task_id}")


def _kept(df: DataFrame, out: str, name: str, task_id: int) -> DataFrame:
    """``df`` stored and read back, with its own layout even where it is empty."""
    _store(df, out, name, task_id)
    kept = df.drop("task_id")
    return df.sparkSession.read.schema(kept.schema).parquet(f"{out}/{name}/task_id={task_id}")


def read_result(spark: SparkSession, out: str, name: str, schema) -> DataFrame:
    return read_slices(spark, f"{out}/{name}", schema)


def session_report(
    spark: SparkSession,
    actions: DataFrame,
    users: DataFrame,
    params: JobParams,
    out: str,
    sample_total: int = 100,
    seed: int = 0,
    top: int = 10,
) -> None:
    """Session statistics, the sample, the top categories and their top sessions."""
    task = params.task_id
    acted = tables.scan_actions(actions, params.dates)

    passed = sessions.filter_sessions(
        sessions.enrich_sessions(sessions.session_rollup(acted), tables.scan_users(users)),
        params.sessions,
    )
    passed = _kept(passed, out, "session_filtered", task)

    ratios = histograms.session_ratios(histograms.session_histogram(passed))
    _store(ratios, out, "session_aggr_stat", task)

    details = sessions.session_details(acted, passed)
    details = _kept(sessions.detail_rows(details, task), out, "session_detail", task)

    chosen = sampling.sample_sessions(passed, sample_total, seed)
    columns = [c for c in schemas.SESSION_RANDOM_EXTRACT.names if c != "task_id"]
    extract = sessions.session_text(chosen).select(*columns)
    extract = _kept(extract, out, "session_random_extract", task)
    _store(sampling.sample_details(details, extract), out, "session_sample_detail", task)

    best = categories.top_categories(categories.category_counts(details), top)
    best = _kept(best, out, "top10_category", task)
    active = categories.top_sessions_by_category(details, best, top).drop("rank")
    active = _kept(active, out, "top10_category_session", task)
    _store(categories.top_session_details(details, active), out, "top10_session_detail", task)


def page_report(actions: DataFrame, params: JobParams, out: str) -> None:
    """Conversion rates of a page flow, as one encoded row."""
    if params.flow is None:
        raise ParameterError("the page report needs a target page flow")
    acted = tables.scan_actions(actions, params.dates)
    rates = funnel.rates_of_steps(funnel.page_steps(acted), params.flow)
    _store(funnel.encode_rates(rates), out, "page_split_convert_rate", params.task_id)


def product_report(
    actions: DataFrame,
    cities: DataFrame,
    product_info: DataFrame,
    params: JobParams,
    out: str,
    levels: Mapping[str, Sequence[str]] = products.AREA_LEVELS,
    other: str = products.OTHER_LEVEL,
    top: int = 3,
) -> None:
    """The top products of each area."""
    clicks = tables.scan_clicks(actions, params.dates)
    best = products.top_products_by_area(clicks, cities, product_info, levels, other, top)
    _store(best, out, "area_top3_product", params.task_id)
