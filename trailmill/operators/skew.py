"""Keeping joins on heavy keys splittable."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh_layout(df: DataFrame) -> DataFrame:
    """``df`` without the partitioning an aggregate left it with; for the small side of a join.

    A side that is already partitioned by the join key is joined as it lies, and adaptive
    execution, which splits heavy keys only right after a shuffle of both sides, must leave one
    task with all rows of a key. Spreading the small side anew keeps the split possible.
    """
    return df.hint("rebalance")
