"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import os
import re
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..plans import scratch

# A word is a run of characters outside these ASCII ranges, after lower-casing A-Z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The same rule for UTF-8 bytes: separators become a space, capitals small letters; bytes from 0x80 stay.
_BYTES = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def byte_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; none for a missing text."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split() if text else []


def word_column(text: Column) -> Column:
    """The words of a text as an array; empty for a missing text. Built-in functions only."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN), "")


def id_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(key.cast("string").cast("binary")) % divisor


def reach_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, unless they already can.

    On a cluster the package is shipped with --py-files; a local path does no harm there.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reach_package(spark)
    bounded_batches(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and no lineage behind it."""
    return scratch.stored(df, f"llm-{name}")


_CACHES: dict[str, Callable[[], None]] = {}


def cached(name: str, clear: Callable[[], None]) -> None:
    """Notes how to empty what an operator remembers in a worker process."""
    _CACHES[name] = clear


def only(*names: str) -> None:
    """Empties what other operators remember: a worker serves one stage after the other, and would keep it all."""
    for name, clear in _CACHES.items():
        if name not in names:
            clear()
    give_back()


# Bytes of one batch on its way to Python, where Spark can bound them: rows may be long.
_BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the batches of rows sent to Python in this session, unless somebody has set a lower bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        now = spark.conf.get(key)
    except PySparkException:  # a Spark without this setting
        return
    found = re.fullmatch(r"(\d+)b?", now)
    if found is None or int(found[1]) > _BATCH_BYTES:
        spark.conf.set(key, str(_BATCH_BYTES))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reach_package(spark)
    bounded_batches(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and no lineage behind it."""
    return scratch.stored(df, f"llm-{name}")


_CACHES: dict[str, Callable[[], None]] = {}


def cached(name: str, clear: Callable[[], None]) -> None:
    """Notes how to empty what an operator remembers in a worker process."""
    _CACHES[name] = clear


def only(*names: str) -> None:
    """Empties what other operators remember: a worker serves one stage after the other, and would keep it all."""
    for name, clear in _CACHES.items():
        if name not in names:
            clear()
    give_back()


# Bytes of one batch on its way to Python, where Spark can bound them: rows may be long.
_BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the batches of rows sent to Python in this session, unless somebody has set a lower bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        now = int(spark.conf.get(key))
    except Exception:  # a Spark without this setting, or one with a unit
        return
    if now > _BATCH_BYTES or now <= 0:
        spark.conf.set(key, str(_BATCH_BYTES))


def lean(run: Callable) -> Callable:
    """A function of Arrow batches that gives memory back to the system when its task ends: workers wait for their next task
    beside stages that need it."""

    @functools.wraps(run)
    def inner(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library alone
    if trim is not None:
        trim(0)


class Carried:
    """The columns ``keep`` of ``docs`` (all, if None) as one struct, so that they may have any names, and the text with them
    only once. ``frame`` has ``row`` and, where the text is not among them as it is, ``text``."""

    def __init__(self, docs: DataFrame, text: str, keep: list[str] | None = None):
        self.names = docs.columns if keep is None else list(keep)
        held = text in self.names and docs.schema[text].dataType == T.StringType()
        self.place = self.names.index(text) if held else None
        own = [] if held else [docs[text].cast("string").alias("text")]
        self.frame = docs.select(F.struct(*[docs[c].alias(c) for c in self.names]).alias("row"), *own)

    def shape(self, results: str) -> T.StructType:
        """``row`` and the results, as a schema."""
        found = T.StructType.fromDDL(results)
        return T.StructType([self.frame.schema["row"], *found.fields])

    def unpacked(self, found: DataFrame, *results: str) -> DataFrame:
        """The kept columns and the results; a kept column with a result's name gives way to it."""
        return found.select(*[F.col("row").getField(c).alias(c) for c in self.names if c not in results], *results)


def text_of(batch: pa.RecordBatch, place: int | None) -> pa.Array:
    """The texts of a batch of a :class:`Carried` frame."""
    return batch.column("text") if place is None else pa.compute.struct_field(batch.column("row"), place)


def slices(batch: pa.RecordBatch, column: str | pa.Array, size: int = 4_000_000):
    """The batch in slices whose texts hold about ``size`` bytes, or one row if that is longer."""
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column) if isinstance(column, str) else column), 0))
    part = np.cumsum(lengths, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(lengths)]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)
