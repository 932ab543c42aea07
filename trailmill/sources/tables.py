"""Scans of the behaviour and dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..functions import times
from ..params import DateRange

# Registered view name -> layout.
BEHAVIOUR_TABLES = {
    "user_visit_action": schemas.USER_VISIT_ACTION,
    "user_info": schemas.USER_INFO,
    "product_info": schemas.PRODUCT_INFO,
    "city_info": schemas.CITY_INFO,
}


def read_table(
    spark: SparkSession, path: str, name: str | None = None, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Read a stored table. Formats without a schema of their own take the known layout."""
    reader = spark.read.format(fmt).options(**options)
    if name is not None and fmt in ("csv", "json"):
        reader = reader.schema(BEHAVIOUR_TABLES[name])
    return reader.load(path)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose tables to SQL under their names; running twice replaces the view."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def with_event_time(actions: DataFrame) -> DataFrame:
    """Add ``ts``. A typed ``action_time`` is used as it is, text is parsed."""
    if "ts" in actions.columns:
        return actions
    kind = actions.schema["action_time"].dataType
    if isinstance(kind, T.StringType):
        return actions.withColumn("ts", times.parse_time("action_time"))
    return actions.withColumn("ts", F.col("action_time").cast("timestamp"))


def in_dates(table: DataFrame, dates: DateRange, column: str = "date") -> DataFrame:
    """Inclusive date range on the stored column, so it prunes partitions and row groups."""
    if dates.start is not None:
        table = table.where(F.col(column) >= dates.start)
    if dates.end is not None:
        table = table.where(F.col(column) <= dates.end)
    return table


def scan_actions(actions: DataFrame, dates: DateRange = DateRange()) -> DataFrame:
    """All action columns in a date range, with their event time.

    A row without a session id belongs to no session and is left out; :func:`rejected_actions` has it.
    """
    return with_event_time(in_dates(actions, dates)).where(F.col("session_id").isNotNull())


_CSV_IDS = ("order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids")


def rejected_actions(actions: DataFrame, dates: DateRange = DateRange()) -> DataFrame:
    """``reason, n``: how many rows of a date range lack what the sessions need, by reason.

    ``no_session``: left out by :func:`scan_actions`. ``bad_time``: an unreadable action time.
    ``bad_ids``: a list of ids with a part that is no number, which counts for no category. A row
    may have several reasons; a reason that no row has is listed with 0.
    """
    bad = F.lit(False)
    for name in _CSV_IDS:
        if name in actions.columns:
            parts = F.split(F.col(name), ",").try_cast("array<bigint>")
            bad = bad | F.exists(parts, lambda x: x.isNull())
    rows = with_event_time(in_dates(actions, dates))
    counts = rows.agg(
        F.count_if(F.col("session_id").isNull()).alias("no_session"),
        F.count_if(F.col("ts").isNull()).alias("bad_time"),
        F.count_if(F.coalesce(bad, F.lit(False))).alias("bad_ids"),
    )
    names = ("no_session", "bad_time", "bad_ids")
    listed = F.array(*[F.struct(F.lit(n).alias("reason"), F.col(n).alias("n")) for n in names])
    return counts.select(F.inline(listed))


def scan_clicks(actions: DataFrame, dates: DateRange = DateRange()) -> DataFrame:
    """``city_id, product_id`` of the product clicks in a date range."""
    clicks = in_dates(actions, dates).where(F.col("click_product_id").isNotNull())
    return clicks.select("city_id", F.col("click_product_id").alias("product_id"))


def scan_users(users: DataFrame) -> DataFrame:
    return users.select(*schemas.USER_INFO.names)
