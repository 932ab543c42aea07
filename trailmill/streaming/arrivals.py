"""Clicks against the watermark: on time, late but kept, late and dropped.

An aggregate drops the rows behind its watermark without a trace. Here a stateful operator, which alone can see the
watermark, labels every click before anything is dropped: the labels are counted, and those that are kept can be followed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .adclicks import EVERY_5_SECONDS, AdTables, start

ON_TIME, KEPT, DROPPED = "on time", "late, kept", "late, dropped"


def arrivals(log: DataFrame, delay_seconds: int, shards: int | None = None) -> DataFrame:
    """``date, arrival, click_count`` of each micro-batch of a streaming click log.

    The watermark of a batch is the newest event time of the batches before it, less the delay. A click is on time if it is
    no older than that newest time, dropped if it is not newer than the watermark, and else late but kept. All clicks
    of the first batch are on time.

    Clicks are dealt to ``shards`` groups (as many as shuffle partitions, if None) by a hash of the whole click, so no key can
    crowd one task; nothing is kept in state, and a batch replayed after a failure has the same watermark and gives the
    same counts.
    """
    shards = shards or int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    delay = delay_seconds * 1000

    def label(_key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        for frame in frames:
            late = pd.Series(ON_TIME, frame.index)
            if watermark > 0:
                late[frame.epoch_ms < watermark + delay] = KEPT
                late[frame.epoch_ms <= watermark] = DROPPED
            counts = frame.groupby([frame.date, late.rename("arrival")]).size().rename("click_count")
            yield counts.reset_index()

    shard = F.pmod(F.xxhash64("ts", "province", "city", "user_id", "ad_id"), F.lit(shards))
    timed = log.withWatermark("ts", f"{delay_seconds} seconds").select(
        "ts", F.date_format("ts", "yyyy-MM-dd").alias("date"), F.unix_millis("ts").alias("epoch_ms"), shard.alias("shard")
    )
    return timed.groupBy("shard").applyInPandasWithState(
        label, "date string, arrival string, click_count bigint", "seen int", "update", GroupStateTimeout.NoTimeout
    )


def start_arrivals_query(
    log: DataFrame, tables: AdTables, delay_seconds: int = 86_400, shards: int | None = None, trigger: dict = EVERY_5_SECONDS
) -> StreamingQuery:
    """Count the clicks of every day by how they arrived, in ``tables.arrivals``; its totals are the counts."""

    def save(batch: DataFrame, batch_id: int) -> None:
        tables.arrivals.publish(batch.groupBy("date", "arrival").agg(F.sum("click_count").alias("click_count")), batch_id)
        tables.arrivals.tidy(batch.sparkSession, tables.compact_every, additive=True)

    return start(arrivals(log, delay_seconds, shards), "arrivals", tables, save, trigger)


def arrival_counts(spark: SparkSession, tables: AdTables) -> DataFrame:
    """``date, arrival, click_count`` of all clicks so far."""
    return tables.arrivals.totals(spark)
