"""Streams replayed file by file must end where one batch ends."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from fixtures import tuples

from pyspark.sql import functions as F

from trailmill import schemas
from trailmill.catalog import inputs, streams
from trailmill.operators import ads
from trailmill.plans.session import CLUSTER_SETTINGS
from trailmill.sinks.tables import BatchTable
from trailmill.sources import adlog
from trailmill.streaming import adclicks
from trailmill.streaming.adclicks import UNTIL_CAUGHT_UP, AdTables

DAY = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC
HOUR = 3_600


class Feed:
    """A folder of log files that grows."""

    def __init__(self, spark, folder):
        self.spark, self.path, self.count = spark, folder / "log", 0
        self.path.mkdir()
        self.tables = AdTables(str(folder / "tables"), files=1)

    def add(self, *rows):
        text = "".join(f"{DAY + s * 1000} {p} {c} {u} {a}\n" for s, p, c, u, a in rows)
        file = self.path / f"part-{self.count:03d}"
        file.write_text(text)
        # Files are streamed by age, and these are written within one tick of the clock.
        os.utime(file, (1_000_000_000 + self.count, 1_000_000_000 + self.count))
        self.count += 1

    def stream(self):
        return adlog.parse_ad_log(adlog.file_lines(self.spark, str(self.path), files_per_batch=1))

    def batch(self):
        return adlog.parse_ad_log(self.spark.read.text(str(self.path)))

    def run_users(self, threshold=3, **kwargs):
        adclicks.start_user_ad_query(
            self.stream(), self.tables, threshold, trigger=UNTIL_CAUGHT_UP, **kwargs
        ).awaitTermination()

    def run_clean(self):
        adclicks.start_clean_query(
            self.stream(), self.tables, trigger=UNTIL_CAUGHT_UP, buckets=3, copies=2
        ).awaitTermination()

    def run_clean_by_lookup(self):
        adclicks.start_clean_by_lookup(
            self.stream(), self.tables, trigger=UNTIL_CAUGHT_UP
        ).awaitTermination()

    def run_stat(self, **kwargs):
        adclicks.start_stat_query(
            adclicks.clean_stream(self.spark, self.tables, 1),
            self.tables,
            trigger=UNTIL_CAUGHT_UP,
            **kwargs,
        ).awaitTermination()

    def run_trend(self):
        adclicks.start_trend_query(
            adclicks.clean_stream(self.spark, self.tables, 1), self.tables, trigger=UNTIL_CAUGHT_UP
        ).awaitTermination()


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


COUNTS = ("date", "user_id", "ad_id", "click_count")
STAT = ("date", "province", "city", "ad_id", "click_count")


def test_user_counts_equal_the_batch_result_and_survive_a_restart(spark, feed):
    for n in range(4):
        feed.add(*[(n * 6 * HOUR + k, "p", "c", k % 3, k % 2) for k in range(12)])
    feed.run_users(threshold=9)
    expected = tuples(ads.user_ad_daily(feed.batch()), *COUNTS)
    assert tuples(feed.tables.user_counts.latest(spark), *COUNTS) == expected
    feed.run_users(threshold=9)
    assert tuples(feed.tables.user_counts.latest(spark), *COUNTS) == expected
    feed.add((24 * HOUR, "p", "c", 8, 1))
    feed.run_users(threshold=9)
    assert tuples(feed.tables.user_counts.latest(spark), *COUNTS) == tuples(
        ads.user_ad_daily(feed.batch()), *COUNTS
    )


def test_blacklist_grows_over_batches_without_repeats(spark, feed):
    feed.add((1, "p", "c", 1, 1), (2, "p", "c", 1, 1), (3, "p", "c", 2, 1))
    feed.run_users()
    assert tuples(feed.tables.blacklist.latest(spark), "user_id") == []
    feed.add((4, "p", "c", 1, 1), (5, "p", "c", 2, 1))  # user 1 reaches three
    feed.run_users()
    assert tuples(feed.tables.blacklist.latest(spark), "user_id") == [(1,)]
    feed.add((6, "p", "c", 1, 1), (7, "p", "c", 2, 1))  # user 1 again, user 2 reaches three
    feed.run_users()
    assert tuples(feed.tables.blacklist.changes(spark), "user_id") == [(1,), (2,)]


@pytest.mark.parametrize("by_lookup", [True, False])
def test_blacklist_is_known_to_every_batch(spark, feed, by_lookup):
    clean = feed.run_clean_by_lookup if by_lookup else feed.run_clean
    feed.add(*[(n, "p", "c", 1, 1) for n in range(3)], (3, "p", "c", 2, 1))
    clean()  # nobody is listed yet
    assert feed.tables.clean_log.changes(spark).count() == 4
    feed.run_users()
    feed.add((5, "p", "c", 1, 1), (6, "p", "c", 2, 1))
    clean()
    got = feed.tables.clean_log.changes(spark)
    assert tuples(got.where("batch_id > 0"), "user_id") == [(2,)]


def test_replayed_batch_drops_the_same_clicks_though_the_blacklist_grew(spark, feed, monkeypatch):
    feed.add(*[(n, "p", "c", 1, 1) for n in range(3)], (3, "p", "c", 2, 1))
    feed.run_users()
    feed.run_clean()  # user 1 is listed
    feed.add((5, "p", "c", 1, 1), (6, "p", "c", 2, 1), (7, "p", "c", 3, 1))
    real = BatchTable.publish
    monkeypatch.setattr(BatchTable, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        feed.run_clean()
    monkeypatch.setattr(BatchTable, "publish", real)
    feed.add((8, "p", "c", 2, 1), (9, "p", "c", 2, 1), (10, "p", "c", 3, 1))
    feed.run_users()  # now user 2 is listed, too
    assert tuples(feed.tables.blacklist.latest(spark), "user_id") == [(1,), (2,)]
    feed.run_clean()
    got = [(r.user_id, r.ts.second, r.batch_id) for r in feed.tables.clean_log.changes(spark).collect()]
    # The batch that was lost knew of user 1 alone; the next one knows of both.
    assert sorted(got) == [(2, 3, 0), (2, 6, 1), (3, 7, 1), (3, 10, 2)]


def test_clicks_of_a_heavy_user_are_dealt_over_the_salts(spark):
    log = spark.range(4000).selectExpr("timestamp_seconds(id) ts", "'p' province", "'c' city", "7L user_id", "id % 9 ad_id")
    shares = log.groupBy(F.pmod(F.xxhash64("ts", "province", "city", "ad_id"), F.lit(adclicks._COPIES))).count().collect()
    assert len(shares) == adclicks._COPIES and max(r["count"] for r in shares) < 4000 / 4


def test_long_blacklist_is_joined_by_shuffle(spark, feed):
    feed.add(*[(n, "p", "c", n % 5, 1) for n in range(60)], (70, "p", "c", 9, 1))
    feed.run_users()
    adclicks.start_clean_by_lookup(
        feed.stream(), feed.tables, UNTIL_CAUGHT_UP, broadcast_users=2
    ).awaitTermination()
    assert tuples(feed.tables.clean_log.changes(spark), "user_id") == [(9,)]


def test_all_queries_together(spark, feed):
    feed.add(*[(60 * n, f"p{n % 2}", "c", n, n % 3) for n in range(20)])
    queries = adclicks.start_all(
        feed.stream(), feed.tables, threshold=99, trigger={"processingTime": "0 seconds"}
    )
    try:
        for query in queries:
            query.processAllAvailable()
        for query in queries[2:]:  # again, for what the clean query stored meanwhile
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    assert tuples(feed.tables.stat.latest(spark), *STAT) == tuples(ads.ad_stat(feed.batch()), *STAT)
    assert feed.tables.trend.latest(spark).count() == 20
    assert adclicks.province_top(spark, feed.tables).count() == 6


def test_stat_and_province_top_equal_the_batch_result(spark, feed):
    for n in range(3):
        feed.add(
            *[
                (n * 10 * HOUR + k, f"p{k % 2}", f"c{k % 4}", 100 + k, (k * k) % 7)
                for k in range(40)
            ]
        )
    feed.run_users(threshold=99)
    feed.run_clean()
    feed.run_stat()
    stat = ads.ad_stat(feed.batch())
    assert tuples(feed.tables.stat.latest(spark), *STAT) == tuples(stat, *STAT)
    top = ("date", "province", "ad_id", "click_count")
    assert tuples(adclicks.province_top(spark, feed.tables), *top) == tuples(
        ads.top_ads_by_province(stat), *top
    )
    feed.run_stat()
    assert tuples(feed.tables.stat.latest(spark), *STAT) == tuples(stat, *STAT)


def test_compaction_between_batches_changes_nothing(spark, feed):
    feed.tables = AdTables(feed.tables.root, files=1, compact_every=2)
    for n in range(5):
        feed.add(
            *[(n * HOUR + k, f"p{k % 2}", "c", k, k % 3 + n) for k in range(6)],
            *[(n * HOUR + k, "p0", "c", 70 + n, 1) for k in range(4)],
        )
    feed.run_users(threshold=4)
    feed.run_clean()
    feed.run_stat()
    feed.run_trend()
    log = ads.exclude_users(feed.batch(), feed.tables.blacklist.latest(spark))
    assert tuples(feed.tables.stat.latest(spark), *STAT) == tuples(ads.ad_stat(log), *STAT)
    assert feed.tables.stat.day("2024-01-01")._published(spark)[0] is not None
    assert tuples(feed.tables.blacklist.latest(spark), "user_id") == [(70 + n,) for n in range(5)]
    minutes = tuples(ads.minute_parts(ads.minute_clicks(log)), "hour", "minute", "click_count")
    assert tuples(feed.tables.trend.latest(spark), "hour", "minute", "click_count") == minutes


def test_top_slices_of_other_days_stay(spark, feed):
    feed.add((0, "p", "c", 1, 1))
    feed.run_clean()
    feed.run_stat()
    feed.add((30 * HOUR, "p", "c", 1, 2), (30 * HOUR, "p", "c", 2, 2))
    feed.run_clean()
    feed.run_stat()
    got = adclicks.province_top(spark, feed.tables)
    assert tuples(got, "date", "province", "ad_id", "click_count") == [
        ("2024-01-01", "p", 1, 1),
        ("2024-01-02", "p", 2, 2),
    ]


def test_trend_equals_the_batch_result(spark, feed):
    for n in range(3):
        feed.add(*[(n * 1500 + 40 * k, "p", "c", k, k % 2) for k in range(30)])
    feed.run_clean()
    feed.run_trend()
    columns = ("date", "hour", "minute", "ad_id", "click_count")
    assert tuples(adclicks.trend(spark, feed.tables), *columns) == tuples(
        ads.click_trend(feed.batch()), *columns
    )


def test_late_clicks_are_dropped_behind_the_watermark(spark, feed):
    feed.add((0, "p", "c", 1, 1))
    feed.run_users(watermark="1 hour")
    feed.add((60 * HOUR, "p", "c", 1, 1))
    feed.run_users(watermark="1 hour")
    feed.add((1, "p", "c", 1, 1), (59 * HOUR, "p", "c", 1, 1))  # two days late, and one hour late
    feed.run_users(watermark="1 hour")
    assert tuples(feed.tables.user_counts.latest(spark), *COUNTS) == [
        ("2024-01-01", 1, 1, 1),
        ("2024-01-03", 1, 1, 2),
    ]


def test_lost_publication_is_repeated_from_the_checkpoint(spark, feed, monkeypatch):
    """The driver dies after a batch published its counts but before the blacklist."""
    feed.add(*[(n, "p", "c", 1, 1) for n in range(3)])
    feed.run_users(threshold=99)
    feed.add(*[(9, "p", "c", 1, 1), (10, "p", "c", 2, 1)])
    real = ads.blacklist
    monkeypatch.setattr(ads, "blacklist", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        feed.run_users(threshold=4)
    monkeypatch.setattr(ads, "blacklist", real)
    feed.run_users(threshold=4)
    assert tuples(feed.tables.user_counts.latest(spark), "user_id", "click_count") == [(1, 4), (2, 1)]
    assert tuples(feed.tables.blacklist.latest(spark), "user_id") == [(1,)]


def test_clean_clicks_are_deleted_once_everybody_has_counted_them(spark, feed):
    for n in range(4):
        feed.add(*[(n * HOUR + k, "p", "c", k, k % 2) for k in range(5)])
    feed.run_clean()
    clean = adclicks.clean_stream(spark, feed.tables, 1)
    stat = adclicks.start_stat_query(clean, feed.tables, trigger=UNTIL_CAUGHT_UP)
    assert stat.awaitTermination() is None
    assert adclicks.trim_clean(spark, feed.tables, []) == 0
    feed.run_trend()  # its progress is not asked for
    assert adclicks.trim_clean(spark, feed.tables, [stat]) == 3
    assert feed.tables.clean_log.since_snapshot(spark) == [3]
    feed.add(*[(9 * HOUR + k, "p", "c", k, k % 2) for k in range(5)])
    feed.run_clean()
    feed.run_stat()
    feed.run_trend()
    assert tuples(feed.tables.stat.latest(spark), *STAT) == tuples(ads.ad_stat(feed.batch()), *STAT)
    assert feed.tables.trend.latest(spark).count() == 10


def test_state_in_rocksdb(spark, feed):
    """The state store recommended for large state gives the same counts."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, CLUSTER_SETTINGS[key])
    try:
        for n in range(2):
            feed.add(*[(n * HOUR + k, "p", "c", k % 3, k % 2) for k in range(12)])
        feed.run_users()
    finally:
        spark.conf.set(key, before)
    expected = tuples(ads.user_ad_daily(feed.batch()), *COUNTS)
    assert tuples(feed.tables.user_counts.latest(spark), *COUNTS) == expected


@pytest.mark.parametrize("kind", ["users", "stat", "trend"])
def test_a_batch_may_bring_rows_of_days_behind_the_newest_one_before(spark, feed, kind):
    """A micro-batch that ends within a week leaves rows of all its days to the next one, as stored clean clicks do when some
    groups of users are empty and a batch has fewer files than its followers take."""
    week = [[(day * 24 * HOUR + 60 * n, f"p{n % 2}", "c", 50 + n, n % 3) for day in range(7 * w, 7 * w + 7) for n in range(4)] for w in range(2)]
    for rows in week:
        feed.add(*rows[::2])
        feed.add(*rows[1::2])
    off = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(off, "false")
    try:
        if kind == "users":
            feed.run_users()
            got, expected = tuples(feed.tables.user_counts.latest(spark), *COUNTS), tuples(ads.user_ad_daily(feed.batch()), *COUNTS)
        else:
            for n, file in enumerate(sorted(feed.path.iterdir())):
                feed.tables.clean_log.publish(adlog.parse_ad_log(spark.read.text(str(file))).coalesce(1), n)
            {"stat": feed.run_stat, "trend": feed.run_trend}[kind]()
            table, counted = {"stat": (feed.tables.stat, ads.ad_stat), "trend": (feed.tables.trend, lambda log: ads.minute_parts(ads.minute_clicks(log)))}[kind]
            columns = STAT if kind == "stat" else ("date", "hour", "minute", "ad_id", "click_count")
            got, expected = tuples(table.latest(spark), *columns), tuples(counted(feed.batch()), *columns)
    finally:
        spark.conf.set(off, "true")
    assert got == expected
    table = {"users": feed.tables.user_counts, "stat": feed.tables.stat, "trend": feed.tables.trend}[kind]
    assert "2024-01-05" not in table.open_days(spark) and table.open_days(spark)[-1] == "2024-01-14"
    assert table.newest_before(spark, 0) is None and table.newest_before(spark, 4) == "2024-01-14"


def test_the_log_is_read_once_for_all_its_parts(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(ad_id):
        seen.add(1)
        return ad_id

    rows = [(datetime(2024, 1, day), "p", "c", day, 1) for day in range(1, 31)]
    log = spark.createDataFrame(rows, schemas.AD_LOG).withColumn("ad_id", counted.asNondeterministic()("ad_id"))
    monkeypatch.setattr(inputs, "ad_log", lambda *_: log)
    lines, _ = streams._arrived(spark, "")
    assert seen.value == 30
    expected = sorted(f"{DAY + (day - 1) * 24 * HOUR * 1000} p c {day} 1" for day in range(1, 31))
    assert sorted(r.value for r in spark.read.text(lines).collect()) == expected
    counts = [spark.read.text(path).count() for path in streams._arriving(spark, "", {3: 1}, beats=1)]
    assert seen.value == 60 and counts == [6, 13, 21, 30, 31]
