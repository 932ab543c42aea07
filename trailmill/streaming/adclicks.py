"""Ad clicks as they arrive: daily counts per user and a blacklist, running counts per province
and city with the top ads, and the trend of the last hour.

Four streaming queries, each with its own checkpoint::

    log ──> user_ad    daily clicks per (user, ad); users over the threshold join the blacklist
    log ──> clean      clicks of users not on the blacklist, whose additions are a stream of their own
    clean ──> stat     running clicks per (day, province, city, ad), top ads per province
    clean ──> trend    clicks per (minute, ad)

Cleaned clicks feed two queries, so they are stored and streamed on. Counts live in Spark's state store; a batch emits the new totals of the keys it
changed, and publishing them by key is an upsert that a replay repeats without effect. Day and
minute windows are grouping keys, so the watermark evicts their state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import schemas
from ..functions import times
from ..operators import ads
from ..sources import adlog
from ..sinks.days import DayTable, open_from
from ..sinks.tables import BATCH, BatchTable, read_slices, replace_slices

EVERY_5_SECONDS = {"processingTime": "5 seconds"}
UNTIL_CAUGHT_UP = {"availableNow": True}

# A list of this many users takes some tens of megabytes in memory: it may be broadcast. A longer
# one is joined by shuffle, a single user's clicks being spread over several tasks.
_BROADCAST_USERS = 1_000_000
_SALTS = 16
# Groups of users in the state of the clean query, and copies of each: fixed for the life of a checkpoint.
_BUCKETS, _COPIES = 32, 8


@dataclass(frozen=True)
class AdTables:
    """Where the streaming jobs keep their tables: one folder all executors share.

    A batch adds a file to a table for each partition of its rows. Counts are kept in folders by day: a batch lists,
    reads and compacts the days it has rows of, every ``compact_every`` batches of a day, and a day behind the
    watermark is closed for good.
    """

    root: str
    files: int | None = None
    compact_every: int = 100

    def _by_day(self, name: str, schema, *keys: str) -> DayTable:
        return DayTable(f"{self.root}/{name}", schema, ("date", *keys), self.files)

    @property
    def user_counts(self) -> DayTable:
        return self._by_day("ad_user_click_count", schemas.AD_USER_CLICK_COUNT, "user_id", "ad_id")

    @property
    def blacklist(self) -> BatchTable:
        """Every user on the list once, in a folder for each batch that listed someone. Snapshots make it quick to read; the
        folders stay, for they are streamed."""
        return BatchTable(f"{self.root}/ad_blacklist", schemas.AD_BLACKLIST, ("user_id",), self.files)

    @property
    def clean_log(self) -> BatchTable:
        return BatchTable(f"{self.root}/clean_log", schemas.AD_LOG, ())

    @property
    def stat(self) -> DayTable:
        return self._by_day("ad_stat", schemas.AD_STAT, "province", "city", "ad_id")

    @property
    def province_top(self) -> str:
        return f"{self.root}/ad_province_top3"

    @property
    def rejected_lines(self) -> str:
        return f"{self.root}/rejected_lines"

    @property
    def trend(self) -> DayTable:
        return self._by_day("ad_click_trend", schemas.AD_CLICK_TREND, "hour", "minute", "ad_id")

    @property
    def arrivals(self) -> BatchTable:
        return BatchTable(f"{self.root}/ad_arrivals", schemas.AD_ARRIVALS, ("date", "arrival"), self.files)

    @property
    def sessions(self) -> DayTable:
        return self._by_day("user_sessions", schemas.USER_SESSIONS, "user_id", "start_time")

    @property
    def view_clicks(self) -> DayTable:
        return self._by_day("view_clicks", schemas.VIEW_CLICKS, "view_id", "click_id")

    @property
    def slides(self) -> BatchTable:
        return BatchTable(f"{self.root}/ad_slides", schemas.AD_SLIDES, (), self.files)

    @property
    def sliding(self) -> DayTable:
        return self._by_day("ad_sliding_trend", schemas.AD_SLIDING_TREND, "ad_id", "slide_end")

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/_checkpoints/{query}"


def start(
    df: DataFrame,
    name: str,
    tables: AdTables,
    save: Callable[[DataFrame, int], None],
    trigger: dict,
    mode: str = "update",
) -> StreamingQuery:
    """Start a query that hands its micro-batches to ``save``, with a checkpoint of its own among the tables'."""
    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", tables.checkpoint(name))
        .foreachBatch(save)
        .trigger(**trigger)
        .start()
    )


def _tend(spark: SparkSession, table: DayTable, batch_id: int, every: int, watermark: str) -> None:
    """Every so many batches compact the days that are open and have as many; close those that get no more rows.

    The next batch may still bring rows that are late by this one's newest: Spark drops those behind the watermark that
    this batch began with.
    """
    seen = table.newest_before(spark, batch_id)
    if batch_id % every == every - 1:
        table.tidy(spark, table.open_days(spark), every)
    if seen is not None:
        table.close(spark, open_from(spark, seen, watermark))


def start_user_ad_query(
    log: DataFrame,
    tables: AdTables,
    threshold: int = ads.BLACKLIST_THRESHOLD,
    watermark: str = "1 day",
    trigger: dict = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Daily clicks per user and ad; users reaching the threshold are added to the blacklist."""

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counts, listed = tables.user_counts, tables.blacklist
        days = counts.publish(batch, batch_id)
        if not days:  # a batch that only moved the watermark
            return
        # Read back what was published rather than running the stateful plan again.
        found = ads.blacklist(counts.batch_rows(spark, batch_id, days), threshold)
        new = found.join(listed.latest(spark), "user_id", "left_anti")
        if not new.isEmpty():
            listed.publish(new, batch_id)
            if len(listed.since_snapshot(spark)) >= tables.compact_every:
                listed.compact(spark)
        _tend(spark, counts, batch_id, tables.compact_every, watermark)

    counts = ads.user_ad_daily(log.withWatermark("ts", watermark))
    return start(counts, "user_ad", tables, save, trigger)


def unlisted(log: DataFrame, listings: DataFrame, buckets: int = _BUCKETS, copies: int = _COPIES) -> DataFrame:
    """The clicks of a stream without those of users whom the stream ``listings`` (user_id) has named, this batch included.

    A stateful anti-join: users are remembered in state, so a batch replayed after a failure drops the same clicks,
    whoever was listed meanwhile. State is kept for buckets of users, not for each, and only for users listed. A
    bucket is remembered ``copies`` times, and clicks are dealt over these, so a user with a third of all clicks fills several tasks.
    """
    columns = schemas.AD_LOG.names

    def keep(_key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(frames)  # a micro-batch's share
        users = set(state.get[0]) if state.exists else set()
        named = {int(u) for frame in held for u in frame.user_id[frame.listed]} - users
        if named:
            users |= named
            state.update((sorted(users),))
        for frame in held:
            kept = frame.loc[~frame.listed & ~frame.user_id.isin(users), columns]
            if len(kept):
                yield kept

    bucket = F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int").alias("bucket")
    salt = F.pmod(F.xxhash64("ts", "province", "city", "ad_id"), F.lit(copies)).cast("int").alias("salt")
    clicks = log.select(*columns, bucket, salt, F.lit(False).alias("listed"))
    nothing = [F.lit(None).cast(schemas.AD_LOG[c].dataType).alias(c) for c in columns if c != "user_id"]
    every = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("salt")
    named = listings.select("user_id", *nothing, bucket, every, F.lit(True).alias("listed"))
    return (
        clicks.unionByName(named)
        .groupBy("bucket", "salt")
        .applyInPandasWithState(keep, schemas.AD_LOG, "users array<bigint>", "append", GroupStateTimeout.NoTimeout)
    )


def listing_stream(spark: SparkSession, tables: AdTables) -> DataFrame:
    """The additions to the blacklist as a stream."""
    tables.blacklist.create(spark)
    return spark.readStream.schema(schemas.AD_BLACKLIST).parquet(f"{tables.blacklist.path}/batch-*")


def start_clean_query(
    log: DataFrame, tables: AdTables, trigger: dict = EVERY_5_SECONDS, buckets: int = _BUCKETS, copies: int = _COPIES
) -> StreamingQuery:
    """Store the clicks of users whom nobody had listed when their batch began.

    At least as many groups (``buckets`` times ``copies``) as there are shuffle partitions keep all of them at work; their
    number stays with the checkpoint.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        tables.clean_log.publish(batch, batch_id)

    kept = unlisted(log, listing_stream(log.sparkSession, tables), buckets, copies)
    return start(kept, "clean", tables, save, trigger, mode="append")


def start_clean_by_lookup(
    log: DataFrame,
    tables: AdTables,
    trigger: dict = EVERY_5_SECONDS,
    broadcast_users: int = _BROADCAST_USERS,
) -> StreamingQuery:
    """The same without state: the blacklist is read for every batch, and a replayed batch may find it longer."""

    def save(batch: DataFrame, batch_id: int) -> None:
        # Counted and joined: computed once.
        listed = tables.blacklist.latest(batch.sparkSession).persist()
        try:
            if listed.count() <= broadcast_users:
                kept = batch.join(F.broadcast(listed), "user_id", "left_anti")
            else:
                kept = ads.exclude_users(batch, listed, _SALTS)
            tables.clean_log.publish(kept, batch_id)
        finally:
            listed.unpersist()

    return start(log, "clean", tables, save, trigger, mode="append")


_CLEAN = "clean_log"


def clean_stream(
    spark: SparkSession, tables: AdTables, files_per_batch: int | None = None
) -> DataFrame:
    """The stored clean clicks as a stream; a query over it tells, with its progress, how far it has come (:func:`trim_clean`)."""
    schema = T.StructType([*schemas.AD_LOG.fields, T.StructField(BATCH, T.LongType())])
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stored = reader.parquet(f"{tables.clean_log.path}/batch-*")
    return stored.observe(_CLEAN, F.max(BATCH).alias("upto")).select(*schemas.AD_LOG.names)


def _read_upto(query: StreamingQuery) -> int | None:
    """The last stored batch of clean clicks that a query has taken rows of, as far as it is known."""
    seen = [p["observedMetrics"][_CLEAN]["upto"] for p in query.recentProgress if _CLEAN in p["observedMetrics"]]
    return max((n for n in seen if n is not None), default=None)


def trim_clean(spark: SparkSession, tables: AdTables, followers: list[StreamingQuery]) -> int:
    """Delete the stored clean clicks that all ``followers`` have gone past, and return how many batches that was.

    Files are streamed by age, so a query that has rows of one batch has taken all of the batches before it.
    """
    upto = [_read_upto(query) for query in followers]
    if not upto or None in upto:  # somebody has not said yet
        return 0
    return tables.clean_log.forget(spark, min(upto))


def start_stat_query(
    clean: DataFrame,
    tables: AdTables,
    top: int | None = 3,
    watermark: str = "1 day",
    trigger: dict = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Running clicks per day, province, city and ad; with ``top``, the top ads per province."""

    def save(batch: DataFrame, batch_id: int) -> None:
        spark, stat = batch.sparkSession, tables.stat
        days = stat.publish(batch, batch_id)
        if not days:  # a batch that only moved the watermark
            return
        if top is not None:
            slices = ["date", "province"]
            best = ads.top_ads_by_province(stat.latest(spark, days), top).select(*schemas.AD_PROVINCE_TOP3.names)
            # Joined last, when a province has only its top rows left.
            changed = stat.batch_rows(spark, batch_id, days).select(*slices).distinct()
            replace_slices(best.join(changed, slices, "left_semi"), tables.province_top, slices)
        _tend(spark, stat, batch_id, tables.compact_every, watermark)

    counts = ads.ad_stat(clean.withWatermark("ts", watermark))
    return start(counts, "stat", tables, save, trigger)


def start_trend_query(
    clean: DataFrame,
    tables: AdTables,
    watermark: str = "60 minutes",
    trigger: dict = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Clicks per minute and ad. A minute is counted once, not in every window it falls into."""

    def save(batch: DataFrame, batch_id: int) -> None:
        if tables.trend.publish(batch, batch_id):
            _tend(batch.sparkSession, tables.trend, batch_id, tables.compact_every, watermark)

    counts = ads.minute_parts(ads.minute_clicks(clean.withWatermark("ts", watermark)))
    return start(counts, "trend", tables, save, trigger)


def start_reject_query(lines: DataFrame, tables: AdTables, trigger: dict = EVERY_5_SECONDS) -> StreamingQuery:
    """Store the lines that the parser leaves out, as they came, in ``rejected_lines``."""
    return (
        adlog.rejected_lines(lines)
        .writeStream.format("parquet")
        .option("path", tables.rejected_lines)
        .option("checkpointLocation", tables.checkpoint("rejected"))
        .trigger(**trigger)
        .start()
    )


def province_top(spark: SparkSession, tables: AdTables) -> DataFrame:
    return read_slices(spark, tables.province_top, schemas.AD_PROVINCE_TOP3)


def trend(spark: SparkSession, tables: AdTables, lookback: str = "60 minutes") -> DataFrame:
    """The stored minutes of the last hour before the newest one. Only the days that hour touches are read."""
    days = tables.trend.days(spark)
    minute = F.concat_ws(" ", "date", "hour", "minute")
    found = tables.trend.changes(spark, days[-1:]).agg(F.to_timestamp(F.max(minute), "yyyy-MM-dd HH mm").alias("newest"))
    first = F.col("newest") - F.expr(f"INTERVAL {lookback}")
    start = found.select(times.format_date(first).alias("day")).first()["day"]
    recent = tables.trend.latest(spark, [day for day in days if day >= start])
    timed = recent.withColumn("at", F.to_timestamp(minute, "yyyy-MM-dd HH mm"))
    return timed.where(F.col("at") > found.select(first).scalar()).drop("at")


def start_all(
    log: DataFrame,
    tables: AdTables,
    threshold: int = ads.BLACKLIST_THRESHOLD,
    top: int | None = 3,
    trigger: dict = EVERY_5_SECONDS,
) -> list[StreamingQuery]:
    """Start the four queries over one log; they run until stopped. The last two follow the clean clicks (:func:`trim_clean`)."""
    spark = log.sparkSession
    tables.clean_log.create(spark)
    clean = clean_stream(spark, tables)
    return [
        start_user_ad_query(log, tables, threshold, trigger=trigger),
        start_clean_query(log, tables, trigger=trigger),
        start_stat_query(clean, tables, top, trigger=trigger),
        start_trend_query(clean, tables, trigger=trigger),
    ]
