"""Clicks of the last hour, per ad, on every slide of ten seconds.

A window of an hour that slides by ten seconds would copy each click into 360 windows. Instead the clicks of each slide are
counted once, and an ad's running total adds the newest slide and subtracts the one that leaves; a timer wakes an ad
when its next slide leaves. A total is given out whenever a slide comes or leaves, and holds until the next one.

    log ──> slides     clicks of each ad and slide, once the watermark has passed it
    slides ──> sliding totals of the hour, by timers

Spark takes no such operator behind an aggregate, so the slides are stored and streamed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import schemas
from .adclicks import EVERY_5_SECONDS, AdTables, start

WINDOW_SECONDS, SLIDE_SECONDS = 3600, 10

_STATE = "ends array<bigint>, counts array<bigint>, total bigint"
_CHANGES = "ad_id bigint, slide_end timestamp, click_count bigint"


def slide_counts(log: DataFrame, slide_seconds: int = SLIDE_SECONDS) -> DataFrame:
    """``ad_id, slide_end, click_count`` of each slide. Map tasks count first, so an ad with a third of all clicks is a row
    for each slide and task."""
    counted = log.groupBy(F.window("ts", f"{slide_seconds} seconds"), "ad_id").agg(F.count("*").alias("click_count"))
    return counted.select("ad_id", F.col("window.end").alias("slide_end"), "click_count")


def start_slide_query(
    log: DataFrame, tables: AdTables, watermark: str = "1 minute", slide_seconds: int = SLIDE_SECONDS, trigger: dict = EVERY_5_SECONDS
) -> StreamingQuery:
    """Store the slides the watermark has passed in ``tables.slides``, each once and whole."""

    def save(batch: DataFrame, batch_id: int) -> None:
        tables.slides.publish(batch, batch_id)

    return start(slide_counts(log.withWatermark("ts", watermark), slide_seconds), "slides", tables, save, trigger, mode="append")


def slide_stream(spark: SparkSession, tables: AdTables, files_per_batch: int | None = None) -> DataFrame:
    """The stored slides as a stream. Later batches have later slides, so none comes behind the watermark."""
    tables.slides.create(spark)
    reader = spark.readStream.schema(schemas.AD_SLIDES)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{tables.slides.path}/batch-*").withWatermark("slide_end", "0 seconds")


def advance(slides: list[tuple[int, int]], total: int, upto: int, length: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]], int]:
    """(moves, left, total): how a total moves when time reaches ``upto``.

    ``slides`` are (end, count) by end; one whose count is negative is part of the total. A slide is added at its end and
    taken away ``length`` later. Moves are (time, total), by time; ``left`` are the slides that have not gone.
    """
    change: dict[int, int] = {}
    left = []
    for end, count in slides:
        if count > 0 and end <= upto:
            change[end] = change.get(end, 0) + count
            count = -count
        if end + length <= upto:
            change[end + length] = change.get(end + length, 0) + count
        else:
            left.append((end, count))
    moves = []
    for at in sorted(change):
        total += change[at]
        moves.append((at, total))
    return moves, left, total


def sliding_counts(slides: DataFrame, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """``ad_id, slide_end, click_count``: the clicks of the hour before ``slide_end``, whenever a slide came or left.

    ``slides`` (:func:`slide_stream`) has every slide once and whole. A slide counts when the watermark, the newest end of the
    batches before, has reached it. State is the slides of the last hour for each ad.
    """
    length = window_seconds * 1000

    def slide(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, total = [], 0
        if state.exists:
            ends, counts, total = state.get
            held = [(int(e), int(c)) for e, c in zip(ends, counts)]
        if not state.hasTimedOut:
            for frame in frames:
                held += zip(frame.end_ms.tolist(), frame.click_count.tolist())
        held.sort()
        upto = state.getCurrentWatermarkMs()
        moves, left, total = advance(held, int(total), upto, length)
        if left:
            state.update(([e for e, _ in left], [c for _, c in left], total))
            state.setTimeoutTimestamp(min(e if c > 0 else e + length for e, c in left))
        elif state.exists:
            state.remove()
        if moves:
            times = pd.to_datetime([at for at, _ in moves], unit="ms", utc=True)
            yield pd.DataFrame({"ad_id": key[0], "slide_end": times, "click_count": [n for _, n in moves]})

    ends = slides.select("ad_id", "slide_end", F.unix_millis("slide_end").alias("end_ms"), "click_count")
    return ends.groupBy("ad_id").applyInPandasWithState(slide, _CHANGES, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def start_sliding_query(
    slides: DataFrame, tables: AdTables, window_seconds: int = WINDOW_SECONDS, trigger: dict = EVERY_5_SECONDS
) -> StreamingQuery:
    """Store the totals of the sliding trend in ``tables.sliding``, by day."""

    def save(batch: DataFrame, batch_id: int) -> None:
        tables.sliding.publish(batch.withColumn("date", F.date_format("slide_end", "yyyy-MM-dd")), batch_id)

    return start(sliding_counts(slides, window_seconds), "sliding", tables, save, trigger, mode="append")


def trend_at(spark: SparkSession, tables: AdTables, slide_ends: list[str], window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """``slide_end, ad_id, click_count`` at the given times (``yyyy-MM-dd HH:mm:ss``, ends of slides); ads without clicks are left out.

    A total above nothing has moved within the hour, so only the days that these hours touch are read.
    """
    hour = F.expr(f"INTERVAL {window_seconds} SECONDS")
    ends = [F.to_timestamp(F.lit(x)) for x in slide_ends]
    touched = spark.range(1).select(F.array_distinct(F.array(*[F.date_format(t, "yyyy-MM-dd") for e in ends for t in (e, e - hour)]))).first()[0]
    rows = tables.sliding.latest(spark, [day for day in tables.sliding.days(spark) if day in touched])
    asked = F.explode(F.filter(F.array(*ends), lambda t: (F.col("slide_end") <= t) & (F.col("slide_end") > t - hour)))
    last = rows.select("ad_id", "slide_end", "click_count", asked.alias("asked")).groupBy("asked", "ad_id")
    found = last.agg(F.max_by("click_count", "slide_end").alias("click_count"))
    return found.where("click_count > 0").select(F.col("asked").alias("slide_end"), "ad_id", "click_count")
