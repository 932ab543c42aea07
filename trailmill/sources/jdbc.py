"""JDBC tables: a partitioned reader and a batched writer.

The driver jar and the database are the caller's; options go straight to Spark's JDBC source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def reader_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a read; with a partition column the table is read by many tasks at once."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    given = [partition_column, lower, upper, partitions]
    if any(value is not None for value in given):
        if any(value is None for value in given):
            raise ValueError("a partitioned read needs its column, both bounds and a count")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**reader_options(url, table, **kwargs)).load()


def writer_options(
    url: str, table: str, batch_size: int = 10_000, connections: int = 50, **extra: str
) -> dict[str, str]:
    """Options of a write: statements go in batches, over at most ``connections`` connections."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        **extra,
    }


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kwargs) -> None:
    df.write.format("jdbc").options(**writer_options(url, table, **kwargs)).mode(mode).save()
