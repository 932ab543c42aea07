"""A Bloom filter of keys, built and tested with built-in functions.

It drops most rows without a partner right above the scan, before a join shuffles them, where the list of keys is too
long to be broadcast whole. It is sized from a count of the keys, ten bits each: about one row in a hundred passes by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_KEY = 10
HASHES = 5
# 16 MB. More keys than that many bits serve (13 million) are left to the join alone.
MOST_BITS = 1 << 27
# What a key of a broadcast list takes, roughly: a list under Spark's threshold prunes the scan by itself.
_KEY_BYTES = 64


def _places(key: Column, bits: int) -> list[Column]:
    first, second = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    # Double hashing; shifted first, so that the sum cannot overflow.
    halves = [F.shiftright(h, 8) for h in (first, second)]
    return [F.pmod(halves[0] + i * halves[1], F.lit(bits)) for i in range(HASHES)]


def words_of(keys: DataFrame, column: str, bits: int) -> DataFrame:
    """One row: the filter as an array of ``bits`` / 64 words. Keys are combined by word before they are gathered."""
    spark = keys.sparkSession
    place = F.col("place")
    word, mask = F.call_function("div", place, F.lit(64)), F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    marks = keys.where(F.col(column).isNotNull()).select(F.explode(F.array(*_places(F.col(column), bits))).alias("place")).select(
        word.alias("word"), mask.alias("mask")
    )
    empty = spark.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("mask"))
    merged = marks.unionByName(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "mask")))
    return merged.agg(F.transform(ordered, lambda x: x["mask"]).alias("words"))


def may_hold(words: Column, key: Column, bits: int) -> Column:
    """Whether the key may be among the filter's; a null key is not."""
    test = key.isNotNull()
    for place in _places(key, bits):
        found = F.get(words, F.call_function("div", place, F.lit(64)).cast("int"))
        test = test & (F.bit_get(found, (place % 64).cast("int")) == 1)
    return test


def bits_for(count: int) -> int:
    return max(64, -(-count * BITS_PER_KEY // 64) * 64)


def pruned(rows: DataFrame, keys: DataFrame, column: str, count: int, always: bool = False) -> DataFrame:
    """The rows whose ``column`` may be among ``count`` keys of that column in ``keys``.

    All rows if the filter would be too large, or if the list is short enough for Spark to broadcast it (unless
    ``always``). ``keys`` is read once more for the filter, so it should be a stored table.
    """
    bits = bits_for(count)
    threshold = int(rows.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    if bits > MOST_BITS or (count * _KEY_BYTES <= threshold and not always):
        return rows
    words = words_of(keys.select(column), column, bits).scalar()
    return rows.where(may_hold(words, F.col(column), bits))
