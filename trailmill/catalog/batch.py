"""Batch queries: sessions, categories, page flow, products, ads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import sql
from ..operators import ads, categories, funnel, histograms, observed, products, sampling, sessions, tasks
from ..plans import scratch
from ..sources import adlog, derived, tables
from . import inputs
from .inputs import FLOW, SAMPLE_SEED, SAMPLE_TOTAL, TASK_ID


# ---- sources -----------------------------------------------------------------------------------
def actions_in_range(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.actions(spark, folder).drop("ts")


def clicks_in_range(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.clicks(spark, folder)


def user_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return tables.scan_users(derived.user_info(spark, folder))


def ad_log_parsed(spark: SparkSession, folder: str) -> DataFrame:
    log = inputs.ad_log(spark, folder)
    return log.select(
        F.unix_millis("ts").alias("epoch_ms"), "province", "city", "user_id", "ad_id"
    )


def ad_log_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return adlog.rejected_lines(derived.ad_lines(spark, folder, one_word=False))


def action_rejects(spark: SparkSession, folder: str) -> DataFrame:
    # The given tables have no bad rows: a seventh lose their session here, some lists get a bad part.
    actions = derived.user_visit_action(spark, folder)
    dirty = actions.withColumn(
        "session_id", F.when(F.col("event_id") % 7 != 0, F.col("session_id"))
    ).withColumn(
        "pay_category_ids",
        F.when(F.col("event_id") % 5 == 0, F.concat("pay_category_ids", F.lit(",x"))).otherwise(
            F.col("pay_category_ids")
        ),
    )
    return tables.rejected_actions(dirty, inputs.DATES)


# ---- sessions ----------------------------------------------------------------------------------
def session_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.session_text(sessions.session_rollup(inputs.actions(spark, folder)))


def session_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.session_text(inputs.enriched(spark, folder))


def session_predicates(spark: SparkSession, folder: str) -> DataFrame:
    tests = sessions.session_predicates(inputs.FILTER)
    tests["sex_equal"] = sessions.equal(F.col("sex"), "female")
    return inputs.enriched(spark, folder).select(
        "session_id", *[F.coalesce(test, F.lit(False)).alias(name) for name, test in tests.items()]
    )


def session_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.session_text(inputs.filtered(spark, folder))


def session_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return histograms.session_histogram(inputs.filtered(spark, folder))


def session_histogram_all(spark: SparkSession, folder: str) -> DataFrame:
    return histograms.session_histogram(
        sessions.session_rollup(inputs.actions(spark, folder))
    )


def session_ratios(spark: SparkSession, folder: str) -> DataFrame:
    return histograms.session_ratios(session_histogram(spark, folder))


def session_detail(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.detail_rows(inputs.details(spark, folder), TASK_ID, "event_id")


def session_hours(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.sessions_per_hour(inputs.filtered(spark, folder))


def session_sample_quota(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.sample_quotas(session_hours(spark, folder), SAMPLE_TOTAL)


def _sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.sample_sessions(
        inputs.filtered_once(spark, folder), SAMPLE_TOTAL, SAMPLE_SEED
    )


def session_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.session_text(_sample(spark, folder)).select(
        "session_id", "start_time", "search_keywords", "click_category_ids", "date", "hour"
    )


def session_sample_detail(spark: SparkSession, folder: str) -> DataFrame:
    # A sampled session passed the filter, so its actions are read without filtering them again.
    chosen = sampling.sample_details(inputs.actions(spark, folder), _sample(spark, folder))
    return sessions.detail_rows(chosen, TASK_ID, "event_id")


def session_detail_pruned(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the Bloom filter, however short the list of sessions is."""
    return sessions.detail_rows(inputs.details(spark, folder, always=True), TASK_ID, "event_id")


# Three tasks over the same dates: the shared one, one without an age range and with a list of cities, one that asks for nothing.
TASKS = (
    (1, '{"startAge": ["20"], "endAge": ["50"], "sex": ["male"], "keywords": ["cake,spa"], "categoryIds": ["1,2,3,4,5"]}'),
    (2, '{"startAge": ["30"], "cities": ["NATION_1,NATION_2,NATION_7"], "sex": ["female"], "keywords": ["mall"]}'),
    (3, "{}"),
)


def session_filtered_by_task(spark: SparkSession, folder: str) -> DataFrame:
    asked = spark.createDataFrame(list(TASKS), "task_id bigint, task_param string")
    return tasks.filter_by_task(inputs.enriched(spark, folder), asked).select("task_id", "session_id", "user_id", "step_length")


def session_histogram_observed(spark: SparkSession, folder: str) -> DataFrame:
    """The histogram of the filtered sessions, taken while these are stored."""
    seen = observed.Watch()
    scratch.stored(histograms.observe_histogram(inputs.filtered(spark, folder), seen), "sessions")
    return histograms.observed_histogram(spark, seen)


def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Diagnostic counts of each stage, from one pass over the actions."""
    seen = observed.Watch()
    acted = seen.count("actions", inputs.actions(spark, folder))
    users = tables.scan_users(derived.user_info(spark, folder))
    rolled = seen.count("sessions", sessions.enrich_sessions(sessions.session_rollup(acted), users))
    observed.run(seen.count("filtered_sessions", sessions.filter_sessions(rolled, inputs.FILTER)))
    return seen.counts(spark)


# ---- categories --------------------------------------------------------------------------------
def category_counts(spark: SparkSession, folder: str) -> DataFrame:
    return categories.category_counts(inputs.details(spark, folder))


def visited_categories(spark: SparkSession, folder: str) -> DataFrame:
    return categories.visited_categories(inputs.details(spark, folder))


def top10_category(spark: SparkSession, folder: str) -> DataFrame:
    return categories.top_categories(category_counts(spark, folder))


def category_session_clicks(spark: SparkSession, folder: str) -> DataFrame:
    return categories.category_session_clicks(inputs.details(spark, folder))


def top10_category_session(spark: SparkSession, folder: str) -> DataFrame:
    return _top_sessions(inputs.details_once(spark, folder))


def _top_sessions(details: DataFrame) -> DataFrame:
    top = categories.top_categories(categories.category_counts(details))
    return categories.top_sessions_by_category(details, top)


def top10_session_detail(spark: SparkSession, folder: str) -> DataFrame:
    details = inputs.details_once(spark, folder)
    chosen = categories.top_session_details(details, _top_sessions(details))
    return sessions.detail_rows(chosen, TASK_ID, "category_id", "event_id")


# ---- page flow ---------------------------------------------------------------------------------
def page_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return funnel.page_pairs(inputs.actions(spark, folder))


def flow_page_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return funnel.flow_pairs(page_pairs(spark, folder), FLOW)


def start_page_visits(spark: SparkSession, folder: str) -> DataFrame:
    return funnel.start_page_visits(inputs.actions(spark, folder), FLOW)


def page_convert_rate(spark: SparkSession, folder: str) -> DataFrame:
    actions = inputs.actions(spark, folder)
    return funnel.rates_of_steps(funnel.page_steps(actions), FLOW)


def page_convert_rate_encoded(spark: SparkSession, folder: str) -> DataFrame:
    return funnel.encode_rates(page_convert_rate(spark, folder))


# ---- products ----------------------------------------------------------------------------------
def area_product_clicks(spark: SparkSession, folder: str) -> DataFrame:
    return products.area_product_clicks(
        inputs.clicks(spark, folder), derived.city_info(spark, folder)
    )


def area_product_full(spark: SparkSession, folder: str) -> DataFrame:
    return products.with_product_info(
        area_product_clicks(spark, folder), derived.product_info(spark, folder)
    )


def area_top3_product(spark: SparkSession, folder: str) -> DataFrame:
    return products.top_products_by_area(
        inputs.clicks(spark, folder),
        derived.city_info(spark, folder),
        derived.product_info(spark, folder),
        inputs.AREA_LEVELS,
        inputs.OTHER_LEVEL,
    )


def area_top3_product_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The same report written as SQL text over registered views."""
    sql.register(spark)
    tables.register_views(
        {
            "user_visit_action": derived.user_visit_action(spark, folder),
            "city_info": derived.city_info(spark, folder),
            "product_info": derived.product_info(spark, folder),
        }
    )
    return spark.sql(
        """
        WITH clicks AS (
          SELECT city_id, click_product_id AS product_id, count(*) AS clicks
          FROM user_visit_action
          WHERE click_product_id IS NOT NULL AND date BETWEEN '2024-01-01' AND '2024-01-31'
          GROUP BY city_id, click_product_id
        ), located AS (
          SELECT area, product_id, clicks,
                 concat_long_string(c.city_id, city_name, ':') AS city
          FROM clicks JOIN city_info c ON clicks.city_id = c.city_id
        ), counted AS (
          SELECT area, product_id, sum(clicks) AS click_count,
                 listagg(DISTINCT city, ',') WITHIN GROUP (ORDER BY city) AS city_infos
          FROM located GROUP BY area, product_id
        ), ranked AS (
          SELECT counted.*, product_name,
                 if(json_field(extend_info, 'product_status') = '0', 'Self', 'Third Party')
                   AS product_status,
                 row_number() OVER (PARTITION BY area ORDER BY click_count DESC, p.product_id)
                   AS rank
          FROM counted JOIN product_info p ON counted.product_id = p.product_id
        )
        SELECT area,
               CASE WHEN area IN ('AFRICA', 'AMERICA') THEN 'A' WHEN area = 'ASIA' THEN 'B'
                    WHEN area = 'EUROPE' THEN 'C' ELSE 'D' END AS area_level,
               product_id, click_count, city_infos, product_name, product_status
        FROM ranked WHERE rank <= 3
        """
    )


# ---- ads ---------------------------------------------------------------------------------------
def ad_user_daily(spark: SparkSession, folder: str) -> DataFrame:
    return ads.user_ad_daily(inputs.ad_log(spark, folder))


def ad_blacklist(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.blacklist(spark, folder)


def ad_filtered(spark: SparkSession, folder: str) -> DataFrame:
    log = inputs.clean_log(spark, folder)
    return log.select(
        F.unix_millis("ts").alias("epoch_ms"), "province", "city", "user_id", "ad_id"
    )


def ad_stat(spark: SparkSession, folder: str) -> DataFrame:
    return ads.ad_stat(inputs.clean_log(spark, folder))


def ad_province_daily(spark: SparkSession, folder: str) -> DataFrame:
    return ads.province_ads(ad_stat(spark, folder))


def ad_province_top3(spark: SparkSession, folder: str) -> DataFrame:
    return ads.top_ads_by_province(ad_stat(spark, folder))


def ad_click_trend(spark: SparkSession, folder: str) -> DataFrame:
    return ads.click_trend(inputs.clean_log(spark, folder))


_ALL = (
    actions_in_range,
    clicks_in_range,
    user_profiles,
    ad_log_parsed,
    ad_log_rejects,
    action_rejects,
    session_rollup,
    session_enriched,
    session_predicates,
    session_filtered,
    session_histogram,
    session_histogram_all,
    session_ratios,
    session_detail,
    session_detail_pruned,
    session_filtered_by_task,
    session_histogram_observed,
    session_hours,
    session_sample_quota,
    session_sample,
    session_sample_detail,
    row_counts,
    category_counts,
    visited_categories,
    top10_category,
    category_session_clicks,
    top10_category_session,
    top10_session_detail,
    page_pairs,
    flow_page_pairs,
    start_page_visits,
    page_convert_rate,
    page_convert_rate_encoded,
    area_product_clicks,
    area_product_full,
    area_top3_product,
    area_top3_product_sql,
    ad_user_daily,
    ad_blacklist,
    ad_filtered,
    ad_stat,
    ad_province_daily,
    ad_province_top3,
    ad_click_trend,
)
QUERIES = {query.__name__: inputs.in_utc(query) for query in _ALL}
