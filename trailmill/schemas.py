"""Row layouts of the inputs and of the result tables."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _INT, _STR, _DBL, _TS = (
    T.LongType(),
    T.IntegerType(),
    T.StringType(),
    T.DoubleType(),
    T.TimestampType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# ---- inputs ----------------------------------------------------------------------------------
USER_VISIT_ACTION = _struct(
    date=_STR,
    user_id=_LONG,
    session_id=_STR,
    page_id=_LONG,
    action_time=_STR,
    search_keyword=_STR,
    click_category_id=_LONG,
    click_product_id=_LONG,
    order_category_ids=_STR,
    order_product_ids=_STR,
    pay_category_ids=_STR,
    pay_product_ids=_STR,
    city_id=_LONG,
)
USER_INFO = _struct(
    user_id=_LONG, username=_STR, name=_STR, age=_INT, professional=_STR, city=_STR, sex=_STR
)
PRODUCT_INFO = _struct(product_id=_LONG, product_name=_STR, extend_info=_STR)
CITY_INFO = _struct(city_id=_INT, city_name=_STR, area=_STR)
AD_LOG = _struct(ts=_TS, province=_STR, city=_STR, user_id=_LONG, ad_id=_LONG)

# ---- histogram buckets ------------------------------------------------------------------------
# Column name -> (lowest, highest) whole seconds, or steps; None means unbounded.
VISIT_LENGTH_BUCKETS = {
    "1s_3s": (1, 3),
    "4s_6s": (4, 6),
    "7s_9s": (7, 9),
    "10s_30s": (10, 29),
    "30s_60s": (30, 59),
    "1m_3m": (60, 179),
    "3m_10m": (180, 599),
    "10m_30m": (600, 1799),
    "30m": (1800, None),
}
STEP_LENGTH_BUCKETS = {
    "1_3": (1, 3),
    "4_6": (4, 6),
    "7_9": (7, 9),
    "10_30": (10, 29),
    "30_60": (30, 60),
    "60": (61, None),
}

# ---- results ----------------------------------------------------------------------------------
SESSION_AGGR_STAT = _struct(
    task_id=_LONG,
    session_count=_LONG,
    **{name: _DBL for name in (*VISIT_LENGTH_BUCKETS, *STEP_LENGTH_BUCKETS)},
)
SESSION_RANDOM_EXTRACT = _struct(
    task_id=_LONG, session_id=_STR, start_time=_STR, search_keywords=_STR, click_category_ids=_STR
)
SESSION_DETAIL = _struct(
    task_id=_LONG,
    user_id=_LONG,
    session_id=_STR,
    page_id=_LONG,
    action_time=_STR,
    search_keyword=_STR,
    click_category_id=_LONG,
    click_product_id=_LONG,
    order_category_ids=_STR,
    order_product_ids=_STR,
    pay_category_ids=_STR,
    pay_product_ids=_STR,
)
TOP10_CATEGORY = _struct(
    task_id=_LONG, category_id=_LONG, click_count=_LONG, order_count=_LONG, pay_count=_LONG
)
TOP10_CATEGORY_SESSION = _struct(
    task_id=_LONG, category_id=_LONG, session_id=_STR, click_count=_LONG
)
PAGE_SPLIT_CONVERT_RATE = _struct(task_id=_LONG, convert_rate=_STR)
AREA_TOP3_PRODUCT = _struct(
    task_id=_LONG,
    area=_STR,
    area_level=_STR,
    product_id=_LONG,
    city_infos=_STR,
    click_count=_LONG,
    product_name=_STR,
    product_status=_STR,
)
AD_USER_CLICK_COUNT = _struct(date=_STR, user_id=_LONG, ad_id=_LONG, click_count=_LONG)
AD_BLACKLIST = _struct(user_id=_LONG)
AD_STAT = _struct(date=_STR, province=_STR, city=_STR, ad_id=_LONG, click_count=_LONG)
AD_PROVINCE_TOP3 = _struct(date=_STR, province=_STR, ad_id=_LONG, click_count=_LONG)
AD_CLICK_TREND = _struct(date=_STR, hour=_STR, minute=_STR, ad_id=_LONG, click_count=_LONG)
# Of the streaming jobs alone.
AD_ARRIVALS = _struct(date=_STR, arrival=_STR, click_count=_LONG)
AD_SLIDES = _struct(ad_id=_LONG, slide_end=_TS, click_count=_LONG)
AD_SLIDING_TREND = _struct(date=_STR, ad_id=_LONG, slide_end=_TS, click_count=_LONG)
USER_SESSIONS = _struct(date=_STR, user_id=_LONG, start_time=_TS, end_time=_TS, click_count=_LONG)
VIEW_CLICKS = _struct(date=_STR, user_id=_LONG, view_id=_LONG, click_id=_LONG, wait_ms=_LONG)
