"""Top-n per group that never gathers a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Beyond this n Spark no longer trims groups before the shuffle by itself.
_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
_SALTS = 64


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """Rows ranked 1..n within each group, with their rank.

    ``row_number() <= n`` lets Spark keep only n rows per group and task before the shuffle, so a
    group holding a third of the table still moves at most n rows per task. Where n is too large
    for that, groups are first ranked in salted parts; the top n of the parts hold the top n.
    """
    if n > int(df.sparkSession.conf.get(_GROUP_LIMIT)):
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(_SALTS))
        part = Window.partitionBy(*keys, "__salt").orderBy(*order)
        df = (
            df.withColumn("__salt", salt)
            .withColumn("__rank", F.row_number().over(part))
            .where(F.col("__rank") <= n)
            .drop("__salt", "__rank")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
