"""Hand-written rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trailmill import schemas


def actions(spark: SparkSession, *rows: dict, with_id: bool = True) -> DataFrame:
    """User actions; what a row does not name is NULL."""
    schema = schemas.USER_VISIT_ACTION
    names = schema.names
    defaults = {"date": "2019-04-21", "user_id": 1, "session_id": "s1", "page_id": 0}
    data = [tuple({**defaults, **row}.get(name) for name in names) for row in rows]
    df = spark.createDataFrame(data, schema)
    if with_id:
        from pyspark.sql import types as T

        full = T.StructType([*schema.fields, T.StructField("event_id", T.LongType())])
        df = spark.createDataFrame([(*row, i) for i, row in enumerate(data)], full)
    return df


def at(seconds: int, day: str = "2019-04-21") -> str:
    """A time of day written the way the logs write it: the hour is not padded."""
    hours, rest = divmod(seconds, 3600)
    return f"{day} {hours}:{rest // 60:02d}:{rest % 60:02d}"


def users(spark: SparkSession, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), schemas.USER_INFO)


def lines(spark: SparkSession, *values: str) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], "value string")


def tuples(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted(
        (tuple(row) for row in df.select(*columns).collect()),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )
