"""The streaming jobs, run over the whole log until they have caught up.

Each query streams the given events, lets the jobs write their tables in a fresh shared folder, and
returns the table asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import ads
from ..plans import reports, scratch
from ..sinks.days import DayTable
from ..sinks.tables import BatchTable, read_slices, replace_slices
from ..sources import adlog, derived
from ..streaming import adclicks, arrivals, behaviour, sliding
from ..streaming.adclicks import UNTIL_CAUGHT_UP, AdTables
from . import batch, inputs


# The log arrives in parts, a week in each, and every part is a micro-batch of its own.
_PARTS = ("2024-01-08", "2024-01-15", "2024-01-22", "9999")
_FAR_AHEAD, _MONTH = 4_102_444_800_000, 2_678_400_000  # 2100 and 31 days, in milliseconds


# Some users' clicks come one or two parts late: user_id % 10 -> parts.
LATE = {3: 1, 7: 2}
ONE_PART_LATE = {3: 1}
# Longer than two parts, so that a click one part late is never behind the watermark.
_TWO_WEEKS = "14 days"


def _part(late: dict[int, int]) -> Column:
    """The part a row with ts and user_id arrives in; the last part has all that is late by then."""
    day = F.date_format("ts", "yyyy-MM-dd")
    place = sum((day >= start).cast("int") for start in _PARTS[:-1])
    for rest, parts in late.items():
        place = place + F.when(F.col("user_id") % 10 == rest, parts).otherwise(0)
    return F.least(place, F.lit(len(_PARTS) - 1))


def _dealt(spark: SparkSession, folder: str, late: dict[int, int]) -> str:
    """The log's lines in a folder for each part: the log is read and parsed once, not once for every part."""
    path = scratch.new_folder(spark, "ad-lines-by-part")
    line = F.concat_ws(" ", F.unix_millis("ts"), "province", "city", "user_id", "ad_id").alias("value")
    inputs.ad_log(spark, folder).select(line, _part(late).alias("part")).write.partitionBy("part").parquet(path)
    return path


def _share(spark: SparkSession, dealt: str, part: int) -> DataFrame:
    """The lines of one part; the others' folders are not read."""
    return spark.read.schema("value string, part int").parquet(dealt).where(F.col("part") == part).select("value")


def _arriving(spark: SparkSession, folder: str, late: dict[int, int] | None = None, beats: int = 0) -> Iterator[str]:
    """A folder of the log's lines, each time one part fuller. All tasks write their share of a part.

    ``beats`` parts with a single line far ahead follow, which move the watermark past everything.
    """
    path, dealt = scratch.new_folder(spark, "ad-lines"), _dealt(spark, folder, late or {})
    for part in range(len(_PARTS)):
        _share(spark, dealt, part).write.mode("append").text(path)
        yield path
    scratch.remove(spark, dealt)
    for beat in range(beats):
        spark.createDataFrame([(f"{_FAR_AHEAD + beat * _MONTH} beat beat -1 -1",)], "value string").write.mode("append").text(path)
        yield path


def _events_arriving(spark: SparkSession, folder: str) -> Iterator[str]:
    """The same for the events themselves: event_id, ts, user_id and event_type, some of them one part late."""
    path = scratch.new_folder(spark, "events")
    events = derived.events(spark, folder).withColumn("part", _part(ONE_PART_LATE))
    for part in range(len(_PARTS)):
        events.where(F.col("part") == part).drop("part").write.mode("append").parquet(path)
        yield path


def _arrived(spark: SparkSession, folder: str) -> tuple[str, int]:
    """The whole log, its parts written one after the other, and how many files a part has: a micro-batch takes as many."""
    path, files = scratch.new_folder(spark, "ad-lines"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _dealt(spark, folder, {})
    for part in range(len(_PARTS)):
        _share(spark, dealt, part).repartition(files).write.mode("append").text(path)
    scratch.remove(spark, dealt)
    return path, files


def _log(spark: SparkSession, lines: str, files: int | None = None) -> DataFrame:
    return adlog.parse_ad_log(adlog.file_lines(spark, lines, files))


def _finish(spark: SparkSession, start: Callable[..., StreamingQuery], *args, **kwargs) -> None:
    """Run a streaming query to the end of its input.

    The extra batch Spark would then run only evicts state nobody will use again.
    """
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        start(*args, trigger=UNTIL_CAUGHT_UP, **kwargs).awaitTermination()
    finally:
        spark.conf.set(setting, before)


def _users(spark: SparkSession, lines: str, files: int) -> AdTables:
    tables = AdTables(scratch.new_folder(spark, "ads"), compact_every=3)
    _finish(spark, adclicks.start_user_ad_query, _log(spark, lines, files), tables, inputs.THRESHOLD)
    return tables


def _following(spark: SparkSession, folder: str, start: Callable[..., StreamingQuery], **kwargs) -> AdTables:
    """Once the blacklist is known the log is cleaned, and ``start`` follows the clean clicks."""
    lines, files = _arrived(spark, folder)
    tables = _users(spark, lines, files)
    _finish(spark, adclicks.start_clean_query, _log(spark, lines, files), tables)
    _finish(spark, start, adclicks.clean_stream(spark, tables, files), tables, **kwargs)
    return tables


def stream_user_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _users(spark, *_arrived(spark, folder)).user_counts.latest(spark)


def stream_blacklist(spark: SparkSession, folder: str) -> DataFrame:
    return _users(spark, *_arrived(spark, folder)).blacklist.latest(spark)


def stream_ad_stat(spark: SparkSession, folder: str) -> DataFrame:
    return _following(spark, folder, adclicks.start_stat_query, top=None).stat.latest(spark)


def stream_province_top3(spark: SparkSession, folder: str) -> DataFrame:
    return adclicks.province_top(spark, _following(spark, folder, adclicks.start_stat_query))


def stream_click_trend(spark: SparkSession, folder: str) -> DataFrame:
    return adclicks.trend(spark, _following(spark, folder, adclicks.start_trend_query))


# ---- late clicks, sessions, joins, sliding windows -----------------------------------------------
ARRIVAL_DELAY = 10 * 86_400
SESSION_GAP = "6 hours"
VIEW_TO_CLICK = 6 * 3600


def stream_late_clicks(spark: SparkSession, folder: str) -> DataFrame:
    tables = AdTables(scratch.new_folder(spark, "ads"), compact_every=3)
    for lines in _arriving(spark, folder, LATE):
        _finish(spark, arrivals.start_arrivals_query, _log(spark, lines), tables, ARRIVAL_DELAY)
    return arrivals.arrival_counts(spark, tables)


def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    tables = AdTables(scratch.new_folder(spark, "ads"))
    for lines in _arriving(spark, folder, ONE_PART_LATE, beats=2):
        _finish(spark, behaviour.start_session_query, _log(spark, lines), tables, SESSION_GAP, _TWO_WEEKS)
    found = tables.sessions.latest(spark)
    return found.select(
        "user_id", F.unix_millis("start_time").alias("start_ms"), F.unix_millis("end_time").alias("end_ms"), "click_count"
    )


def stream_view_to_click(spark: SparkSession, folder: str) -> DataFrame:
    tables = AdTables(scratch.new_folder(spark, "ads"))
    for path in _events_arriving(spark, folder):
        # Each side is a stream of its own, with its own watermark.
        views, clicks = (
            spark.readStream.schema(derived.EVENT_SCHEMA).parquet(path).where(F.col("event_type") == kind) for kind in ("view", "click")
        )
        _finish(spark, behaviour.start_view_click_query, views, clicks, tables, VIEW_TO_CLICK, _TWO_WEEKS)
    return tables.view_clicks.latest(spark).drop("date")


def stream_sliding_trend(spark: SparkSession, folder: str) -> DataFrame:
    tables = AdTables(scratch.new_folder(spark, "ads"))
    # The slides of the first beats, passed by the later ones, move the second query's clock.
    for lines in _arriving(spark, folder, ONE_PART_LATE, beats=4):
        _finish(spark, sliding.start_slide_query, _log(spark, lines), tables, _TWO_WEEKS)
        _finish(spark, sliding.start_sliding_query, sliding.slide_stream(spark, tables), tables)
    found = tables.sliding.latest(spark).where("ad_id >= 0")
    return found.select("ad_id", F.unix_millis("slide_end").alias("slide_end_ms"), "click_count")


# ---- sinks -------------------------------------------------------------------------------------
def _batches(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The log's daily counts in two batches: the first half of the month, then all of it."""
    counts = ads.ad_stat(inputs.ad_log(spark, folder))
    return [counts.where("date < '2024-01-16'"), counts]


def sink_upsert_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Upsert that replaces: rows given twice, and a batch replayed, count once."""
    first, second = _batches(spark, folder)
    keys = ("date", "province", "city", "ad_id")
    table = BatchTable(scratch.new_folder(spark, "upsert"), schemas.AD_STAT, keys)
    for batch_id, rows in ((0, first), (1, second), (1, second)):
        table.publish(rows, batch_id)
    table.compact(spark)
    return table.latest(spark)


def sink_upsert_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """Upsert in folders by day: every week's counts come twice, the second time whole; days before the week are closed."""
    counts = ads.ad_stat(inputs.ad_log(spark, folder))
    table = DayTable(scratch.new_folder(spark, "by-day"), schemas.AD_STAT, ("date", "province", "city", "ad_id"))
    for week, (start, end) in enumerate(zip(("", *_PARTS), _PARTS)):
        rows = counts.where((F.col("date") >= start) & (F.col("date") < end))
        for batch_id, part in ((2 * week, rows.withColumn("click_count", F.lit(0).cast("bigint"))), (2 * week + 1, rows)):
            table.tidy(spark, table.publish(part, batch_id), every=2)
            table.close(spark, start)
    return table.latest(spark)


def sink_upsert_add(spark: SparkSession, folder: str) -> DataFrame:
    """Upsert that adds: the two batches' counts add up, a replayed batch does not."""
    first, second = _batches(spark, folder)
    keys = ("date", "province", "city", "ad_id")
    table = BatchTable(scratch.new_folder(spark, "add"), schemas.AD_STAT, keys)
    for batch_id, rows in ((0, first), (1, second), (0, first)):
        table.publish(rows, batch_id)
    return table.totals(spark)


def sink_replace_task(spark: SparkSession, folder: str) -> DataFrame:
    """A report's rows by task: one task is run again and finds nothing, the other keeps its rows."""
    path = scratch.new_folder(spark, "tasks")
    best = batch.QUERIES["area_top3_product"](spark, folder)
    for task, rows in ((1, best), (2, best), (2, best.where("false"))):
        reports._store(rows, path, "area_top3_product", task)
    kept = reports.read_result(spark, path, "area_top3_product", schemas.AREA_TOP3_PRODUCT)
    return kept.select(F.col("task_id").cast("int").alias("task_id"), "area", "product_id", "click_count")


def sink_replace_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Delete-and-insert by (date, province): a second write leaves other slices alone."""
    path = scratch.new_folder(spark, "slices")
    top = ads.top_ads_by_province(ads.ad_stat(inputs.ad_log(spark, folder))).drop("rank")
    slices = ["date", "province"]
    replace_slices(top, path, slices)
    replace_slices(top.where("date >= '2024-01-16'").withColumn("ad_id", -top.ad_id), path, slices)
    return read_slices(spark, path, schemas.AD_PROVINCE_TOP3)


_ALL = (
    stream_user_daily,
    stream_blacklist,
    stream_ad_stat,
    stream_province_top3,
    stream_click_trend,
    stream_late_clicks,
    stream_sessions,
    stream_view_to_click,
    stream_sliding_trend,
    sink_upsert_replace,
    sink_upsert_by_day,
    sink_upsert_add,
    sink_replace_task,
    sink_replace_slices,
)
QUERIES = {query.__name__: inputs.in_utc(query) for query in _ALL}
