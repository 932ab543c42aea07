"""The SQL each registered query is checked against, run by DuckDB over the same tables."""

from __future__ import annotations

from .inputs import SAMPLE_SEED, SAMPLE_TOTAL, TASK_ID, THRESHOLD

_EVENTS = """
ev AS (
  SELECT event_id, user_id, event_type, ts,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(floor(epoch(ts)) AS BIGINT) AS es
  FROM events
), sq AS (
  SELECT *, es // 604800 AS wk,
         CASE user_id % 6 WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 100
                          WHEN 3 THEN 1000 WHEN 4 THEN 10000 ELSE 100000 END AS f
  FROM ev
), timed AS (
  SELECT *, make_timestamp(CAST(
           (wk * 604800 + (user_id * 3600) % 86400 + (es - wk * 604800) // f) * 1000000
         AS BIGINT)) AS t
  FROM sq
), all_actions AS (
  SELECT strftime(t, '%Y-%m-%d') AS date, user_id,
         's' || user_id || '_' || wk AS session_id, k % 10 AS page_id,
         strftime(t, '%Y-%m-%d %-H:%M:%S') AS action_time,
         CASE WHEN event_type = 'view' THEN
           CASE k % 5 WHEN 0 THEN 'hotpot' WHEN 1 THEN 'cake' WHEN 2 THEN 'noodles'
                      WHEN 3 THEN 'mall' ELSE 'spa' END END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN (k % 20) || ',' || ((k + 7) % 20) END
           AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 20 AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_product_ids,
         event_id % 25 AS city_id, event_id, t
  FROM timed
), actions AS (
  SELECT * FROM all_actions WHERE date BETWEEN '2024-01-01' AND '2024-01-31'
)"""

_USERS = """
users AS (
  SELECT c_custkey AS user_id, c_name AS username, 'name' || c_custkey AS name,
         CAST(18 + c_custkey % 43 AS INTEGER) AS age, c_mktsegment AS professional,
         n_name AS city, CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

_CITIES = """
cities AS (
  SELECT n_nationkey AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         '{"product_status": ' || (p_partkey % 2) || '}' AS extend_info
  FROM part
)"""

_SESSIONS = f"""
{_EVENTS}, {_USERS}, rollup_ AS (
  SELECT session_id, max(user_id) AS user_id, min(t) AS start_t, max(t) AS end_t,
         CAST(epoch(max(t)) - epoch(min(t)) AS BIGINT) AS visit_length,
         count(*) AS step_length,
         list_sort(list_distinct(list(search_keyword) FILTER (WHERE search_keyword <> '')))
           AS kw,
         list_sort(list_distinct(list(click_category_id)
           FILTER (WHERE click_category_id IS NOT NULL))) AS cat
  FROM actions GROUP BY session_id
), enriched AS (
  SELECT r.*, age, professional, city, sex FROM rollup_ r JOIN users u ON r.user_id = u.user_id
), tested AS (
  SELECT *, age BETWEEN 20 AND 50 AS age_ok, sex = 'male' AS sex_ok,
         coalesce(list_has_any(kw, ['cake', 'spa']), false) AS kw_ok,
         coalesce(list_has_any(cat, CAST([1, 2, 3, 4, 5] AS BIGINT[])), false) AS cat_ok
  FROM enriched
), filtered AS (
  SELECT * FROM tested WHERE age_ok AND sex_ok AND kw_ok AND cat_ok
), details AS (
  SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM filtered)
)"""

_TEXT = """
       session_id, user_id, strftime(start_t, '%Y-%m-%d %H:%M:%S') AS start_time,
       strftime(end_t, '%Y-%m-%d %H:%M:%S') AS end_time, visit_length, step_length,
       coalesce(array_to_string(kw, ','), '') AS search_keywords,
       coalesce(array_to_string(cat, ','), '') AS click_category_ids"""

_BUCKETS = {
    "1s_3s": "visit_length BETWEEN 1 AND 3",
    "4s_6s": "visit_length BETWEEN 4 AND 6",
    "7s_9s": "visit_length BETWEEN 7 AND 9",
    "10s_30s": "visit_length >= 10 AND visit_length < 30",
    "30s_60s": "visit_length >= 30 AND visit_length < 60",
    "1m_3m": "visit_length >= 60 AND visit_length < 180",
    "3m_10m": "visit_length >= 180 AND visit_length < 600",
    "10m_30m": "visit_length >= 600 AND visit_length < 1800",
    "30m": "visit_length >= 1800",
    "1_3": "step_length BETWEEN 1 AND 3",
    "4_6": "step_length BETWEEN 4 AND 6",
    "7_9": "step_length BETWEEN 7 AND 9",
    "10_30": "step_length >= 10 AND step_length < 30",
    "30_60": "step_length BETWEEN 30 AND 60",
    "60": "step_length > 60",
}


def _histogram(table: str) -> str:
    counts = ", ".join(
        f'count(*) FILTER (WHERE {test}) AS "{name}"' for name, test in _BUCKETS.items()
    )
    return f"SELECT count(*) AS session_count, {counts} FROM {table}"


def _ratio(part: str, whole: str, unit: int = 100) -> str:
    return (
        f"CASE WHEN {whole} > 0 THEN (({2 * unit} * {part} + {whole}) // (2 * {whole})) "
        f"/ {unit}.0::DOUBLE ELSE 0.0::DOUBLE END"
    )


_RATIOS = ", ".join(f'{_ratio(chr(34) + n + chr(34), "session_count")} AS "{n}"' for n in _BUCKETS)

_DETAIL = f"""CAST({TASK_ID} AS BIGINT) AS task_id, a.user_id, a.session_id, a.page_id,
       a.action_time, a.search_keyword, a.click_category_id, a.click_product_id,
       a.order_category_ids, a.order_product_ids, a.pay_category_ids, a.pay_product_ids,
       a.event_id"""

_SAMPLE = f"""
{_SESSIONS}, placed AS (
  SELECT *, strftime(start_t, '%Y-%m-%d') AS date, strftime(start_t, '%H') AS hour FROM filtered
), hours AS (
  SELECT date, hour, count(*) AS session_count,
         CAST(sum(count(*)) OVER (PARTITION BY date) AS BIGINT) AS day_count
  FROM placed GROUP BY date, hour
), quotas AS (
  SELECT *, CAST(least(session_count, session_count
             * ({SAMPLE_TOTAL} // (SELECT count(DISTINCT date) FROM hours)) // day_count)
           AS BIGINT) AS quota
  FROM hours
), sample_ AS (
  SELECT p.* FROM (
    SELECT *, row_number() OVER (PARTITION BY date, hour
                ORDER BY md5(session_id || '#{SAMPLE_SEED}'), session_id) AS draw FROM placed
  ) p JOIN quotas q ON p.date = q.date AND p.hour = q.hour WHERE draw <= quota
)"""

_CATEGORIES = f"""
{_SESSIONS}, touched AS (
  SELECT 'click' AS kind, click_category_id AS category_id FROM details
  UNION ALL
  SELECT 'order', CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT) FROM details
  UNION ALL
  SELECT 'pay', CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT) FROM details
), counts AS (
  SELECT category_id, count(*) FILTER (WHERE kind = 'click') AS click_count,
         count(*) FILTER (WHERE kind = 'order') AS order_count,
         count(*) FILTER (WHERE kind = 'pay') AS pay_count
  FROM touched WHERE category_id IS NOT NULL GROUP BY category_id
), top_ AS (
  SELECT * FROM counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
), session_clicks AS (
  SELECT click_category_id AS category_id, session_id, count(*) AS click_count
  FROM details WHERE click_category_id IS NOT NULL GROUP BY ALL
), top_sessions AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY category_id
                ORDER BY click_count DESC, session_id) AS rank
    FROM session_clicks WHERE category_id IN (SELECT category_id FROM top_)
  ) WHERE rank <= 10
)"""

_PAIRS = f"""
{_EVENTS}, followed AS (
  SELECT page_id AS from_page,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY t, event_id) AS to_page
  FROM actions
), pairs AS (
  SELECT from_page, to_page, count(*) AS pv FROM followed
  WHERE to_page IS NOT NULL GROUP BY ALL
), flow AS (
  SELECT * FROM (VALUES (1, 1, 2), (2, 2, 3), (3, 3, 4)) AS v(step, a, b)
), step_pv AS (
  SELECT step, a || '_' || b AS page_split, coalesce(pv, 0) AS pv
  FROM flow LEFT JOIN pairs ON a = from_page AND b = to_page
), rates AS (
  SELECT step, page_split, pv,
         coalesce(lag(pv) OVER (ORDER BY step),
                  (SELECT count(*) FROM actions WHERE page_id = 1)) AS base_pv
  FROM step_pv
), convert AS (
  SELECT *, {_ratio("pv", "base_pv")} AS convert_rate FROM rates
)"""

_AREA = f"""
{_EVENTS}, {_CITIES}, {_PRODUCTS}, area_clicks AS (
  SELECT area, click_product_id AS product_id, count(*) AS click_count,
         string_agg(DISTINCT a.city_id || ':' || city_name, ','
                    ORDER BY a.city_id || ':' || city_name) AS city_infos
  FROM actions a JOIN cities c ON a.city_id = c.city_id
  WHERE click_product_id IS NOT NULL GROUP BY area, click_product_id
), area_full AS (
  SELECT a.*, product_name,
         CASE WHEN json_extract_string(extend_info, '$.product_status') = '0'
              THEN 'Self' ELSE 'Third Party' END AS product_status
  FROM area_clicks a JOIN products p ON a.product_id = p.product_id
), area_top AS (
  SELECT area, CASE WHEN area IN ('AFRICA', 'AMERICA') THEN 'A' WHEN area = 'ASIA' THEN 'B'
                    WHEN area = 'EUROPE' THEN 'C' ELSE 'D' END AS area_level,
         product_id, click_count, city_infos, product_name, product_status
  FROM (SELECT *, row_number() OVER (PARTITION BY area
                    ORDER BY click_count DESC, product_id) AS rank FROM area_full)
  WHERE rank <= 3
)"""

_ADS = f"""
{_CITIES}, log AS (
  SELECT ts, epoch_us(ts) // 1000 AS epoch_ms, replace(area, ' ', '-') AS province, city_name AS city,
         user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS ad_id
  FROM events JOIN cities ON event_id % 25 = city_id
), user_daily AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, ad_id, count(*) AS click_count
  FROM log GROUP BY ALL
), black AS (
  SELECT DISTINCT user_id FROM user_daily WHERE click_count >= {THRESHOLD}
), clean AS (
  SELECT * FROM log WHERE user_id NOT IN (SELECT user_id FROM black)
), stat AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, province, city, ad_id, count(*) AS click_count
  FROM clean GROUP BY ALL
), province_daily AS (
  SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
  FROM stat GROUP BY ALL
), province_top AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY date, province
                ORDER BY click_count DESC, ad_id) AS rank FROM province_daily
  ) WHERE rank <= 3
), trend AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour,
         strftime(ts, '%M') AS minute, ad_id, count(*) AS click_count
  FROM clean
  WHERE date_trunc('minute', ts)
        > (SELECT date_trunc('minute', max(ts)) FROM clean) - INTERVAL 60 MINUTE
  GROUP BY ALL
)"""


# The same, said of the whole log.
_LOG_STAT = """
SELECT strftime(ts, '%Y-%m-%d') AS date, province, city, ad_id, count(*) AS click_count
FROM log GROUP BY ALL"""


# Clicks by the part they arrive in. The newest time of the parts before says what is late; ten days later it is dropped.
_LATE_CLICKS = """
SELECT date, arrival, count(*) AS click_count
FROM (
  SELECT strftime(ts, '%Y-%m-%d') AS date,
         CASE WHEN newest IS NULL OR epoch_ms >= newest THEN 'on time'
              WHEN epoch_ms > newest - 864000000 THEN 'late, kept' ELSE 'late, dropped' END AS arrival
  FROM (
    SELECT *, least(3, CAST(ts >= '2024-01-08' AS INT) + CAST(ts >= '2024-01-15' AS INT) + CAST(ts >= '2024-01-22' AS INT)
                       + CASE user_id % 10 WHEN 3 THEN 1 WHEN 7 THEN 2 ELSE 0 END) AS part
    FROM log
  ) placed LEFT JOIN (
    SELECT part, max(max(epoch_ms)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
    FROM (
      SELECT epoch_ms, least(3, CAST(ts >= '2024-01-08' AS INT) + CAST(ts >= '2024-01-15' AS INT) + CAST(ts >= '2024-01-22' AS INT)
                                + CASE user_id % 10 WHEN 3 THEN 1 WHEN 7 THEN 2 ELSE 0 END) AS part
      FROM log
    ) GROUP BY part
  ) clock USING (part)
) GROUP BY ALL"""

_USER_SESSIONS = """
SELECT user_id, min(epoch_ms) AS start_ms, max(epoch_ms) AS end_ms, count(*) AS click_count
FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY epoch_ms, fresh DESC ROWS UNBOUNDED PRECEDING) AS session
  FROM (
    SELECT user_id, epoch_ms,
           CASE WHEN epoch_ms - lag(epoch_ms) OVER (PARTITION BY user_id ORDER BY epoch_ms) < 21600000 THEN 0 ELSE 1 END AS fresh
    FROM log
  )
) GROUP BY user_id, session"""

_VIEW_TO_CLICK = """
SELECT v.user_id, v.event_id AS view_id, c.event_id AS click_id, epoch_us(c.ts) // 1000 - epoch_us(v.ts) // 1000 AS wait_ms
FROM events v JOIN events c ON c.user_id = v.user_id AND c.ts >= v.ts AND c.ts <= v.ts + INTERVAL 6 HOUR
WHERE v.event_type = 'view' AND c.event_type = 'click'"""

# A slide of ten seconds counts from its end on, for an hour.
_SLIDING = """
SELECT ad_id, slide_end_ms, CAST(sum(sum(n)) OVER (PARTITION BY ad_id ORDER BY slide_end_ms) AS BIGINT) AS click_count
FROM (
  SELECT ad_id, (epoch_ms // 10000 + 1) * 10000 AS slide_end_ms, 1 AS n FROM log
  UNION ALL
  SELECT ad_id, (epoch_ms // 10000 + 1) * 10000 + 3600000, -1 FROM log
) GROUP BY ad_id, slide_end_ms"""


def _select(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


_AD_QUERIES = {
    "ad_log_parsed": "SELECT epoch_ms, province, city, user_id, ad_id FROM log",
    "ad_user_daily": "SELECT * FROM user_daily",
    "ad_blacklist": "SELECT * FROM black",
    "ad_filtered": "SELECT epoch_ms, province, city, user_id, ad_id FROM clean",
    "ad_stat": "SELECT * FROM stat",
    "ad_province_daily": "SELECT * FROM province_daily",
    "ad_province_top3": "SELECT * FROM province_top",
    "ad_click_trend": "SELECT * FROM trend",
}

ORACLES = {
    "actions_in_range": _select(_EVENTS, "SELECT * EXCLUDE (t) FROM actions"),
    "clicks_in_range": _select(
        _EVENTS,
        "SELECT city_id, click_product_id AS product_id FROM actions "
        "WHERE click_product_id IS NOT NULL",
    ),
    "user_profiles": _select(_USERS, "SELECT * FROM users"),
    "action_rejects": _select(
        _EVENTS,
        "SELECT 'no_session' AS reason, count(*) AS n FROM actions WHERE event_id % 7 = 0 "
        "UNION ALL SELECT 'bad_time', 0 UNION ALL SELECT 'bad_ids', count(*) FROM actions "
        "WHERE event_id % 5 = 0 AND pay_category_ids IS NOT NULL",
    ),
    "ad_log_rejects": _select(
        _CITIES,
        "SELECT (epoch_us(ts) // 1000) || ' ' || area || ' ' || city_name || ' ' || user_id || ' ' || "
        "(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10) AS value "
        "FROM events JOIN cities ON event_id % 25 = city_id WHERE contains(area, ' ')",
    ),
    "session_rollup": _select(_SESSIONS, f"SELECT {_TEXT} FROM rollup_"),
    "session_enriched": _select(
        _SESSIONS, f"SELECT {_TEXT}, age, professional, city, sex FROM enriched"
    ),
    "session_predicates": _select(
        _SESSIONS,
        "SELECT session_id, age_ok AS age, sex_ok AS sex, kw_ok AS keywords, "
        "cat_ok AS categories, sex = 'female' AS sex_equal FROM tested",
    ),
    "session_filtered": _select(
        _SESSIONS, f"SELECT {_TEXT}, age, professional, city, sex FROM filtered"
    ),
    "session_histogram": _select(_SESSIONS, _histogram("filtered")),
    "session_histogram_all": _select(_SESSIONS, _histogram("rollup_")),
    "session_ratios": _select(
        _SESSIONS, f"SELECT session_count, {_RATIOS} FROM ({_histogram('filtered')})"
    ),
    "session_detail": _select(_SESSIONS, f"SELECT {_DETAIL} FROM details a"),
    "session_detail_pruned": _select(_SESSIONS, f"SELECT {_DETAIL} FROM details a"),
    "session_filtered_by_task": _select(
        _SESSIONS,
        "SELECT CAST(1 AS BIGINT) AS task_id, session_id, user_id, step_length FROM filtered UNION ALL "
        "SELECT 2, session_id, user_id, step_length FROM enriched WHERE sex = 'female' "
        "AND city IN ('NATION_1', 'NATION_2', 'NATION_7') AND list_contains(kw, 'mall') UNION ALL "
        "SELECT 3, session_id, user_id, step_length FROM enriched",
    ),
    "session_histogram_observed": _select(_SESSIONS, _histogram("filtered")),
    "session_hours": _select(_SAMPLE, "SELECT * FROM hours"),
    "session_sample_quota": _select(_SAMPLE, "SELECT * FROM quotas"),
    "session_sample": _select(
        _SAMPLE,
        "SELECT session_id, start_time, search_keywords, click_category_ids, date, hour "
        f"FROM (SELECT {_TEXT}, date, hour FROM sample_)",
    ),
    "session_sample_detail": _select(
        _SAMPLE,
        f"SELECT {_DETAIL} FROM actions a WHERE session_id IN (SELECT session_id FROM sample_)",
    ),
    "row_counts": _select(
        _SESSIONS,
        "SELECT 'actions' AS stage, count(*) AS n FROM actions UNION ALL "
        "SELECT 'sessions', count(*) FROM enriched UNION ALL "
        "SELECT 'filtered_sessions', count(*) FROM filtered",
    ),
    "category_counts": _select(_CATEGORIES, "SELECT * FROM counts"),
    "visited_categories": _select(_CATEGORIES, "SELECT category_id FROM counts"),
    "top10_category": _select(_CATEGORIES, "SELECT * FROM top_"),
    "category_session_clicks": _select(_CATEGORIES, "SELECT * FROM session_clicks"),
    "top10_category_session": _select(_CATEGORIES, "SELECT * FROM top_sessions"),
    "top10_session_detail": _select(
        _CATEGORIES,
        f"SELECT {_DETAIL}, s.category_id FROM actions a "
        "JOIN top_sessions s ON a.session_id = s.session_id",
    ),
    "page_pairs": _select(_PAIRS, "SELECT * FROM pairs"),
    "flow_page_pairs": _select(
        _PAIRS, "SELECT pairs.* FROM pairs JOIN flow ON a = from_page AND b = to_page"
    ),
    "start_page_visits": _select(
        _PAIRS, "SELECT count(*) AS start_pv FROM actions WHERE page_id = 1"
    ),
    "page_convert_rate": _select(_PAIRS, "SELECT * FROM convert"),
    "page_convert_rate_encoded": _select(
        _PAIRS,
        "SELECT string_agg(page_split || '=' || CAST(convert_rate AS VARCHAR), '|' "
        "ORDER BY step) AS convert_rate FROM convert",
    ),
    "area_product_clicks": _select(_AREA, "SELECT * FROM area_clicks"),
    "area_product_full": _select(_AREA, "SELECT * FROM area_full"),
    "area_top3_product": _select(_AREA, "SELECT * FROM area_top"),
    "area_top3_product_sql": _select(_AREA, "SELECT * FROM area_top"),
    **{name: _select(_ADS, body) for name, body in _AD_QUERIES.items()},
    "stream_user_daily": _select(_ADS, "SELECT * FROM user_daily"),
    "stream_blacklist": _select(_ADS, "SELECT * FROM black"),
    "stream_ad_stat": _select(_ADS, "SELECT * FROM stat"),
    "stream_province_top3": _select(_ADS, "SELECT * EXCLUDE (rank) FROM province_top"),
    "stream_click_trend": _select(_ADS, "SELECT * FROM trend"),
    "stream_late_clicks": _select(_ADS, _LATE_CLICKS),
    "stream_sessions": _select(_ADS, _USER_SESSIONS),
    "stream_view_to_click": _VIEW_TO_CLICK,
    "stream_sliding_trend": _select(_ADS, _SLIDING),
    "sink_upsert_replace": _select(_ADS, _LOG_STAT),
    "sink_upsert_by_day": _select(_ADS, _LOG_STAT),
    "sink_upsert_add": _select(
        _ADS,
        "SELECT date, province, city, ad_id, CASE WHEN date < '2024-01-16' THEN 2 ELSE 1 END "
        f"* click_count AS click_count FROM ({_LOG_STAT})",
    ),
    "sink_replace_task": _select(
        _AREA,
        "SELECT task_id, area, product_id, click_count FROM (SELECT 1 AS task_id, * FROM area_top "
        "UNION ALL SELECT 2, * FROM area_top WHERE false)",
    ),
    "sink_replace_slices": _select(
        _ADS,
        "SELECT date, province, CASE WHEN date < '2024-01-16' THEN ad_id ELSE -ad_id END "
        "AS ad_id, click_count FROM (SELECT *, row_number() OVER (PARTITION BY date, province "
        "ORDER BY click_count DESC, ad_id) AS rank FROM (SELECT date, province, ad_id, "
        f"CAST(sum(click_count) AS BIGINT) AS click_count FROM ({_LOG_STAT}) GROUP BY ALL)) "
        "WHERE rank <= 3",
    ),
    "scalar_string": _select(
        _USERS,
        "SELECT user_id, CAST(age AS VARCHAR) AS age_text, CAST(NULL AS VARCHAR) AS note, "
        "CAST(NULL AS VARCHAR) AS missing, "
        "'age=' || age || '|city=X|sex=' || sex || '|note=' AS packed_set, "
        "name || ',x' AS trimmed, lpad(CAST(user_id % 100 AS VARCHAR), 2, '0') AS padded, "
        "user_id || ':' || city AS joined, user_id || ':null' AS joined_null, "
        "true AS note_empty, city <> '' AS city_given, sex || ',' || city AS items, "
        "2 AS id_count, user_id AS second_id FROM users",
    ),
    "scalar_date": _select(
        _EVENTS,
        "SELECT event_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS time, "
        "strftime(t, '%Y-%m-%d') AS date, strftime(t, '%Y%m%d') AS date_key, "
        "strftime(t, '%Y%m%d%H%M') AS minute_key, strftime(t, '%Y-%m-%d_%H') AS date_hour, "
        "strftime(t, '%Y-%m-%d') AS key_date, "
        "t < TIMESTAMP '2024-01-15 09:30:00' AS is_before, "
        "t > TIMESTAMP '2024-01-15 09:30:00' AS is_after, "
        "CAST(epoch(t) - epoch(TIMESTAMP '2024-01-15 09:30:00') AS BIGINT) AS seconds_after, "
        "CAST(0 AS BIGINT) AS seconds_unreadable, true AS unreadable, "
        "strftime(make_timestamp(event_id * 86461000000), '%Y-%m-%d %H:%M:%S') AS from_ms, "
        "strftime(now() AT TIME ZONE 'UTC', '%Y-%m-%d') AS today, "
        "strftime(now() AT TIME ZONE 'UTC' - INTERVAL 1 DAY, '%Y-%m-%d') AS yesterday "
        "FROM all_actions",
    ),
    "scalar_number": (
        f"SELECT event_id, {_ratio('(event_id % 97)', '(event_id % 41)')} AS ratio, "
        f"{_ratio('(event_id % 97)', '(event_id % 41)', 1000)} AS ratio_3, "
        "((20 * (event_id % 97) + 8) // 16) / 10.0::DOUBLE AS rounded, "
        "0.0::DOUBLE AS not_a_number FROM events"
    ),
    "scalar_json": _select(
        _PRODUCTS,
        "SELECT product_id, json_extract_string(extend_info, '$.product_status') AS status, "
        "CAST(NULL AS VARCHAR) AS missing, CAST(NULL AS VARCHAR) AS malformed, "
        "CASE WHEN product_id % 2 = 0 THEN 'Self' ELSE 'Third Party' END AS seller, "
        "'Third Party' AS seller_malformed, product_name AS param, "
        "CAST(NULL AS VARCHAR) AS param_empty, CAST(NULL AS VARCHAR) AS param_absent "
        "FROM products",
    ),
    "scalar_area_level": _select(
        _CITIES,
        "SELECT city_id, CASE WHEN city_id % 7 IN (0, 1) THEN 'A级' "
        "WHEN city_id % 7 IN (2, 3) THEN 'B级' WHEN city_id % 7 IN (4, 5) THEN 'C级' "
        "ELSE 'D级' END AS default_level, CASE WHEN area IN ('AFRICA', 'AMERICA') THEN 'A' "
        "WHEN area = 'ASIA' THEN 'B' WHEN area = 'EUROPE' THEN 'C' ELSE 'D' END AS level "
        "FROM cities",
    ),
}
