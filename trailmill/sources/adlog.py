"""The ad-click log: lines of ``epoch_ms province city user_id ad_id``.

Every function works on batch and on streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def kafka_lines(
    spark: SparkSession, brokers: str, topics: str, starting: str = "earliest", **options: str
) -> DataFrame:
    """Streaming ``value`` lines from Kafka topics (needs Spark's Kafka package on the cluster)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topics)
        .option("startingOffsets", starting)
    )
    return reader.options(**options).load().select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming ``value`` lines from text files as they arrive."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _parsed(lines: DataFrame) -> tuple[DataFrame, Column]:
    # Exploding a one-element array splits each line once; as a plain column the split would be
    # repeated in every condition that Spark moves below it.
    part = F.col("part")
    fields = lines.select("value", F.explode(F.array(F.split("value", " "))).alias("part")).select(
        "value",
        F.size(part).alias("parts"),
        F.get(part, F.lit(0)).try_cast("bigint").alias("epoch_ms"),
        F.get(part, F.lit(1)).alias("province"),
        F.get(part, F.lit(2)).alias("city"),
        F.get(part, F.lit(3)).try_cast("bigint").alias("user_id"),
        F.get(part, F.lit(4)).try_cast("bigint").alias("ad_id"),
    )
    readable = (
        (F.col("parts") == 5)
        & F.col("epoch_ms").isNotNull()
        & (F.col("province") != "")
        & (F.col("city") != "")
        & F.col("user_id").isNotNull()
        & F.col("ad_id").isNotNull()
    )
    return fields, F.coalesce(readable, F.lit(False))


def parse_ad_log(lines: DataFrame) -> DataFrame:
    """``ts, province, city, user_id, ad_id`` of the readable lines."""
    fields, readable = _parsed(lines)
    return fields.where(readable).select(
        F.timestamp_millis("epoch_ms").alias("ts"), "province", "city", "user_id", "ad_id"
    )


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The lines :func:`parse_ad_log` leaves out, as they came."""
    fields, readable = _parsed(lines)
    return fields.where(~readable).select("value")
