"""Late clicks, merging sessions, joined streams and the sliding trend, micro-batch by micro-batch."""

from __future__ import annotations

import random

import pytest
from fixtures import tuples
from test_streaming import DAY, HOUR, Feed

from trailmill.streaming import arrivals, behaviour, sliding
from trailmill.streaming.adclicks import UNTIL_CAUGHT_UP, AdTables
from trailmill.streaming.sliding import advance


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


@pytest.fixture
def data_batches_only(spark):
    """No extra micro-batches that only move state, so batches are those of the files."""
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


# ---- late clicks -------------------------------------------------------------------------------
def _arrive(feed, **kwargs):
    arrivals.start_arrivals_query(feed.stream(), feed.tables, trigger=UNTIL_CAUGHT_UP, **kwargs).awaitTermination()


def test_clicks_are_told_by_how_they_arrive(spark, feed):
    feed.add((100, "p", "c", 1, 1), (0, "p", "c", 2, 1))  # nothing is late in the first batch
    _arrive(feed, delay_seconds=50)
    feed.add((100, "p", "c", 1, 1), (99, "p", "c", 1, 1), (51, "p", "c", 1, 1), (50, "p", "c", 1, 1), (1, "p", "c", 1, 1))
    feed.add((500, "p", "c", 3, 1), (449, "p", "c", 3, 1))  # later than all before: on time
    _arrive(feed, delay_seconds=50)
    columns = ("arrival", "click_count")
    assert tuples(arrivals.arrival_counts(spark, feed.tables), *columns) == [
        (arrivals.DROPPED, 2), (arrivals.KEPT, 2), (arrivals.ON_TIME, 5),
    ]


def test_dropped_clicks_are_those_an_aggregate_drops(spark, feed):
    """The counts by user of what is kept equal those of an aggregate over windows as short as a click."""
    feed.add(*[(n * 60, "p", "c", n % 3, 1) for n in range(20)])
    feed.add(*[(n * 60, "p", "c", n % 3, 1) for n in range(20)], (3000, "p", "c", 0, 1))
    _arrive(feed, delay_seconds=600)
    counts = dict(tuples(arrivals.arrival_counts(spark, feed.tables), "arrival", "click_count"))
    # Newest before: 19 minutes, so up to 9 minutes is dropped.
    assert counts == {arrivals.ON_TIME: 22, arrivals.KEPT: 9, arrivals.DROPPED: 10}


def test_a_replayed_batch_counts_once(spark, feed, monkeypatch):
    feed.tables = AdTables(feed.tables.root, files=1, compact_every=2)
    feed.add((100, "p", "c", 1, 1))
    _arrive(feed, delay_seconds=10)
    feed.add((95, "p", "c", 1, 1), (5, "p", "c", 1, 1))
    real = type(feed.tables.arrivals).tidy
    monkeypatch.setattr(type(feed.tables.arrivals), "tidy", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        _arrive(feed, delay_seconds=10)
    monkeypatch.setattr(type(feed.tables.arrivals), "tidy", real)
    feed.add((200, "p", "c", 1, 1))
    _arrive(feed, delay_seconds=10)
    assert dict(tuples(arrivals.arrival_counts(spark, feed.tables), "arrival", "click_count")) == {
        arrivals.ON_TIME: 2, arrivals.KEPT: 1, arrivals.DROPPED: 1,
    }


# ---- sessions ----------------------------------------------------------------------------------
def _sessions(feed, **kwargs):
    query = behaviour.start_session_query(feed.stream(), feed.tables, trigger=UNTIL_CAUGHT_UP, **kwargs)
    query.awaitTermination()
    return query


def _found(spark, feed):
    rows = feed.tables.sessions.latest(spark).collect()
    return sorted((r.user_id, int(r.start_time.timestamp()) - DAY // 1000, int(r.end_time.timestamp()) - DAY // 1000, r.click_count) for r in rows)


def test_a_late_click_joins_two_sessions(spark, feed, data_batches_only):
    settings = {"gap": "10 minutes", "watermark": "2 hours"}
    feed.add((0, "p", "c", 1, 1), (900, "p", "c", 1, 1), (0, "p", "c", 2, 1), (900, "p", "c", 2, 1))
    _sessions(feed, **settings)
    assert _found(spark, feed) == []  # all are open
    feed.add((450, "p", "c", 1, 1))
    feed.add((9 * HOUR, "p", "c", 9, 1))
    feed.add((10 * HOUR, "p", "c", 9, 1))
    _sessions(feed, **settings)
    assert _found(spark, feed) == [(1, 0, 900, 3), (2, 0, 0, 1), (2, 900, 900, 1)]


def test_sessions_equal_the_batch_result_and_leave_the_state(spark, feed, data_batches_only):
    rng = random.Random(2)
    clicks = [(rng.randrange(30 * HOUR), "p", "c", n % 5, 1) for n in range(300)]
    for n in range(6):
        feed.add(*[c for c in clicks if c[0] // (5 * HOUR) == n])
    far = [(90 * HOUR + n, "p", "c", -1, 1) for n in range(2)]
    for beat in far:
        feed.add(beat)
    query = _sessions(feed, gap="20 minutes", watermark="1 hour")
    batch = behaviour.user_sessions(feed.batch().where("user_id >= 0"), "20 minutes")
    columns = ("user_id", "start_time", "end_time", "click_count")
    assert tuples(feed.tables.sessions.latest(spark), *columns) == tuples(batch, *columns)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) > 5 and kept[-1] <= 1  # the last one's own


# ---- joined streams ----------------------------------------------------------------------------
class Events:
    """A folder of events that grows; views and clicks are two streams over it."""

    SHAPE = "event_id bigint, ts timestamp, user_id bigint, event_type string"

    def __init__(self, spark, folder):
        self.spark, self.path = spark, f"{folder}/events"
        self.tables = AdTables(f"{folder}/tables", files=1)

    def add(self, *rows):
        made = self.spark.createDataFrame(list(rows), "event_id bigint, s double, user_id bigint, event_type string")
        made.selectExpr("event_id", f"timestamp_millis(cast({DAY} + s * 1000 as bigint)) ts", "user_id", "event_type").coalesce(1).write.mode(
            "append"
        ).parquet(self.path)

    def run(self, **kwargs):
        sides = [self.spark.readStream.schema(self.SHAPE).parquet(self.path).where(f"event_type = '{k}'") for k in ("view", "click")]
        query = behaviour.start_view_click_query(*sides, self.tables, trigger=UNTIL_CAUGHT_UP, **kwargs)
        query.awaitTermination()
        return query

    def found(self):
        return tuples(self.tables.view_clicks.latest(self.spark), "view_id", "click_id", "wait_ms")


def test_clicks_meet_views_whichever_comes_first(spark, tmp_path, data_batches_only):
    events = Events(spark, tmp_path)
    events.add((1, 0.0, 7, "view"), (2, 10.0, 7, "click"), (3, 3599.0, 8, "view"), (4, 30.0, 9, "click"), (5, 50.0, 7, "error"))
    events.run()
    assert events.found() == [(1, 2, 10_000)]
    events.add((6, 3600.0, 7, "click"), (7, 3601.0, 7, "click"), (8, 7199.0, 8, "click"), (9, 20.0, 9, "view"))
    events.run()
    # The interval's end counts; a click after it and one before its view do not; the view of user 9 came late.
    assert events.found() == [(1, 2, 10_000), (1, 6, 3_600_000), (3, 8, 3_600_000), (9, 4, 10_000)]


def test_both_sides_leave_the_state(spark, tmp_path, data_batches_only):
    events = Events(spark, tmp_path)
    kept = []
    for n in range(5):
        base = n * 10 * HOUR
        events.add(*[(100 * n + k, base + k * 7.0, k % 10, "view" if k % 2 else "click") for k in range(60)])
        query = events.run(within_seconds=60, watermark="1 hour")
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    # A part has 30 views, which stand in two slices each, and 30 clicks; parts before the last one are gone.
    assert kept[0] == 90 and max(kept) <= 2 * 90


def test_join_of_any_events_equals_the_batch_join(spark, tmp_path, data_batches_only):
    rng = random.Random(8)
    rows = [(n, round(rng.uniform(0, 3000), 3), rng.randrange(3), rng.choice(["view", "click"])) for n in range(120)]
    events = Events(spark, tmp_path)
    for part in (rows[:50], rows[50:80], rows[80:]):  # in no order of time
        events.add(*part)
        events.run(within_seconds=45, watermark="1 day")
    wanted = [
        (v[0], c[0], round((c[1] - v[1]) * 1000))
        for v in rows for c in rows
        if v[3] == "view" and c[3] == "click" and v[2] == c[2] and 0 <= c[1] - v[1] <= 45
    ]
    assert sorted(events.found()) == sorted(wanted)


# ---- sliding trend -----------------------------------------------------------------------------
def test_a_total_adds_what_comes_and_subtracts_what_leaves():
    moves, left, total = advance([(10, 2), (20, 1)], 0, 25, 15)
    assert (moves, left, total) == ([(10, 2), (20, 3), (25, 1)], [(20, -1)], 1)
    moves, left, total = advance([*left, (30, 4)], total, 29, 15)
    assert (moves, left, total) == ([], [(20, -1), (30, 4)], 1)
    moves, left, total = advance(left, total, 100, 15)
    assert (moves, left, total) == ([(30, 5), (35, 4), (45, 0)], [], 0)


def _slide(spark, feed, watermark, window_seconds):
    sliding.start_slide_query(feed.stream(), feed.tables, watermark, trigger=UNTIL_CAUGHT_UP).awaitTermination()
    slides = sliding.slide_stream(spark, feed.tables, files_per_batch=1)
    query = sliding.start_sliding_query(slides, feed.tables, window_seconds, trigger=UNTIL_CAUGHT_UP)
    query.awaitTermination()
    return query


def _at(clicks, ends, length):
    """(slide end, ad, clicks) by counting."""
    counts = {}
    for end in ends:
        for t, *_, ad in clicks:
            if end - length <= t < end:
                counts[end, ad] = counts.get((end, ad), 0) + 1
    return sorted((end, ad, n) for (end, ad), n in counts.items())


def test_every_slide_has_the_clicks_of_its_window(spark, feed, data_batches_only):
    rng = random.Random(5)
    clicks = sorted((rng.randrange(900), "p", "c", n, n % 3) for n in range(200))
    for n in range(3):
        feed.add(*[c for c in clicks if c[0] // 300 == n])
    for beat in range(5000, 9000, 1000):
        feed.add((beat, "p", "c", 1, 99))
    query = _slide(spark, feed, "1 minute", 120)
    ends = range(10, 1100, 10)
    asked = [f"2024-01-01 00:{end // 60:02d}:{end % 60:02d}" for end in ends]
    got = sliding.trend_at(spark, feed.tables, asked, window_seconds=120)
    found = sorted((int(r.slide_end.timestamp()) - DAY // 1000, r.ad_id, r.click_count) for r in got.collect())
    assert found == _at(clicks, ends, 120)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held[-1] <= 1  # the last beat's own


def test_timers_take_clicks_away_when_an_ad_is_silent(spark, feed, data_batches_only):
    feed.add((5, "p", "c", 1, 1))
    for beat in range(400, 2400, 400):
        feed.add((beat, "p", "c", 1, 2))
    _slide(spark, feed, "10 seconds", 60)
    rows = feed.tables.sliding.latest(spark).where("ad_id = 1").collect()
    assert sorted((int(r.slide_end.timestamp()) - DAY // 1000, r.click_count) for r in rows) == [(10, 1), (70, 0)]
