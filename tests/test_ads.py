from __future__ import annotations

from fixtures import lines, tuples

from trailmill.operators import ads
from trailmill.sources import adlog

DAY = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC


def _log(spark, *rows):
    return adlog.parse_ad_log(
        lines(spark, *[f"{DAY + s * 1000} {p} {c} {u} {a}" for s, p, c, u, a in rows])
    )


def test_unreadable_lines_are_set_aside(spark):
    raw = lines(spark, f"{DAY} p c 7 3", f"{DAY} p c 7", f"{DAY} p c seven 3", "", f"x p c 7 3", f"{DAY} p c 7 3 9", f"{DAY}   7 3")
    assert tuples(adlog.parse_ad_log(raw), "province", "city", "user_id", "ad_id") == [
        ("p", "c", 7, 3)
    ]
    assert adlog.rejected_lines(raw).count() == 6


def test_blacklist_threshold_and_distinct_users(spark):
    rows = [(n, "p", "c", 1, a) for n in range(3) for a in (1, 2)]
    rows += [(n, "p", "c", 2, a) for n in range(2) for a in (1, 2)]
    rows += [(86_400 * d, "p", "c", 3, 1) for d in range(3)]
    counts = ads.user_ad_daily(_log(spark, *rows))
    assert tuples(ads.blacklist(counts, 3), "user_id") == [(1,)]
    assert tuples(ads.blacklist(counts, 15), "user_id") == []


def test_exclude_users_salted_or_not(spark):
    log = _log(spark, *[(n, "p", f"c{n}", n % 3, n) for n in range(30)])
    listed = spark.createDataFrame([(1,), (7,)], "user_id long")
    plain = tuples(ads.exclude_users(log, listed), "user_id", "ad_id")
    assert len(plain) == 20
    assert tuples(ads.exclude_users(log, listed, salts=8), "user_id", "ad_id") == plain


def test_province_top_is_per_day(spark):
    rows = [(0, "p", "c1", 1, a) for a in (1, 2, 3, 4)] + [(0, "p", "c2", 1, 4)]
    rows += [(86_400, "p", "c1", 1, 9)]
    got = ads.top_ads_by_province(ads.ad_stat(_log(spark, *rows)))
    assert tuples(got, "date", "province", "ad_id", "click_count", "rank") == [
        ("2024-01-01", "p", 1, 1, 2),
        ("2024-01-01", "p", 2, 1, 3),
        ("2024-01-01", "p", 4, 2, 1),
        ("2024-01-02", "p", 9, 1, 1),
    ]


def test_trend_counts_minutes_of_the_last_hour(spark):
    rows = [(0, "p", "c", 1, 1), (59, "p", "c", 2, 1), (60, "p", "c", 3, 1), (3600, "p", "c", 4, 1)]
    got = ads.click_trend(_log(spark, *rows))
    assert tuples(got, "date", "hour", "minute", "ad_id", "click_count") == [
        ("2024-01-01", "00", "01", 1, 1),
        ("2024-01-01", "01", "00", 1, 1),
    ]
    late = ads.click_trend(_log(spark, *rows), clock=_log(spark, (7100, "p", "c", 1, 1)))
    assert tuples(late, "hour", "minute") == [("01", "00")]
