"""Bulk-synchronous best-fit packing.

Documents longer than a sequence are cut into whole sequences and one shorter first piece; only the shorter
pieces need a place. They are packed in rounds. A round sorts the open pieces and the gaps of the open sequences
into ranges by size and sweeps each range upwards with a stack: a piece is laid on it, a gap takes the top, the
largest piece that fits and is still free. That is best fit for both sides, and pieces that want one gap are told
apart by their rank, the size and then the number. What a range leaves over, gaps too small for its pieces and
pieces without a gap behind them, is matched between ranges: from the ranges' counts alone the driver finds which
places in one range meet which in another, and the rows meet by a shuffle on the number of their pair. The largest
pieces left then open as many new sequences as any packing needs at least, and the gaps shrink. Rounds end when
every piece has its place.

A gap takes one piece in a round, or one in each of several slots as large as the largest open piece: so small
pieces fill large gaps in few rounds, and a round reads no more than the gaps and thrice the pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from . import tokens
from .common import lean, slices, stored
from .pfor import with_end

CAPACITY = 1024
# Sizes above capacity / 2, / 3, ... / _CLASSES have bounds of their own for the sequences they need.
_CLASSES = 12

_PIECE = "number bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_SWEPT = "number bigint, size int, sequence_id bigint, slot int, room int, part int, place bigint"


def cut_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 2, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Each document's ids with ``end_id`` in pieces of ``capacity``, the first as short as need be: number (of no
    other piece), doc_id, piece, start, length, ids_crc32 and, if asked for, the ids. A null text has the end id alone."""
    names = ["number", "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, number = tokens.encoder(path), TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text"):
                offsets, ids = with_end(*coder.encode(part.column("text")), end_id)
                total = np.diff(offsets)
                pieces = -(-total // capacity)
                row = np.repeat(np.arange(len(total)), pieces)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = (total - (pieces - 1) * capacity)[row]
                start = np.where(nth == 0, 0, first + (nth - 1) * capacity)
                length = np.where(nth == 0, first, capacity)
                at = offsets[row] + start
                raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
                columns = [
                    pa.array(number + np.arange(len(row))),
                    part.column("key").take(pa.array(row)),
                    pa.array(nth.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array([zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at, length)], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(np.append(at, len(ids)).astype(np.int32), ids.astype(np.int32)))
                number += len(row)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(docs[key].cast("bigint").alias("key"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(lean(cut), _PIECE + ", ids array<int>" * with_ids)


# ---- one round ------------------------------------------------------------------------------------
def needed(items: np.ndarray, gaps: np.ndarray, capacity: int) -> int:
    """How many new sequences any packing needs at least: ``items[s]`` pieces and ``gaps[s]`` gaps of each size s.

    By volume; and by number for the pieces above capacity / (m + 1), of which a sequence holds m at most.
    """
    size = np.arange(capacity + 1)
    most = -(-(int(items @ size) - int(gaps @ size)) // capacity)
    for m in range(1, _CLASSES):
        held = np.maximum(-(-size * (m + 1) // capacity) - 1, 0)  # such pieces in a gap of this size, at most
        most = max(most, -(-(int(items[size * (m + 1) > capacity].sum()) - int(gaps @ held)) // m))
    return max(most, 0)


def match(gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, gaps): places that a stack matches in a sequence of pieces (false) and gaps (true).

    The stack's height after a piece is its level; the next gap to fall from there takes it. On one level pieces and
    gaps alternate, so matches are neighbours once the places are sorted by level.
    """
    height = np.cumsum(np.where(gap, -1, 1))
    level = height + gap
    order = np.argsort(level, kind="stable")
    paired = np.flatnonzero((level[order][1:] == level[order][:-1]) & ~gap[order][:-1] & gap[order][1:])
    return order[paired], order[paired + 1]


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches one range; ``place`` numbers the gaps left over, and the pieces left over, in the range's order."""
    if not (batches := list(batches)):
        return
    held = pa.Table.from_batches(batches)
    columns = {n: np.asarray(held.column(n).combine_chunks().fill_null(0)) for n in held.column_names}
    gap = columns["kind"] == 1
    piece, taker = match(gap)
    free = np.ones(len(gap), bool)
    free[piece] = free[taker] = False
    left_gap, left_piece = np.flatnonzero(free & gap), np.flatnonzero(free & ~gap)
    n, g, p = len(piece), len(left_gap), len(left_piece)
    part = TaskContext.get().partitionId()

    def column(name, pieces: bool, kind):
        """A column of the matched rows, the gaps left over and the pieces left over."""
        values = columns[name]
        own = [values[piece], np.zeros(g, values.dtype), values[left_piece]] if pieces else [values[taker], values[left_gap], np.zeros(p, values.dtype)]
        absent = np.repeat([False, pieces, not pieces], [n, g, p])
        return pa.array(np.concatenate(own), kind, mask=absent)

    yield pa.RecordBatch.from_arrays(
        [
            column("number", True, pa.int64()),
            column("size", True, pa.int32()),
            column("number", False, pa.int64()),
            column("slot", False, pa.int32()),
            column("room", False, pa.int32()),
            pa.array(np.full(n + g + p, part), pa.int32()),
            pa.array(np.concatenate([np.zeros(n, np.int64), np.arange(g), np.arange(p)]), mask=np.arange(n + g + p) < n),
        ],
        names=["number", "size", "sequence_id", "slot", "room", "part", "place"],
    )


def between_ranges(counts: list[tuple[int, int, int]], fresh: int) -> list[tuple]:
    """Which places left over in the ranges meet: rows (part, gap, low, high, pair, step).

    ``counts`` has (part, gaps, pieces) left over, by part. The place x of low <= x < high is in pair
    ``pair + step * (x - low)``. The ``fresh`` largest pieces that stay alone open a sequence: their pair is null.
    """
    stack, rows, pair = [], [], 0
    for part, gaps, pieces in counts:
        done = 0
        while done < gaps and stack:
            below, low, high = stack.pop()
            n = min(gaps - done, high - low)
            rows += [(part, True, done, done + n, pair, 1), (below, False, high - n, high, pair + n - 1, -1)]
            if high - n > low:
                stack.append((below, low, high - n))
            done, pair = done + n, pair + n
        if pieces:
            stack.append((part, 0, pieces))
    while fresh and stack:
        below, low, high = stack.pop()
        n = min(fresh, high - low)
        rows.append((below, False, high - n, high, None, 0))
        fresh -= n
    return rows


def _round(items: DataFrame, gaps: DataFrame, capacity: int) -> DataFrame | None:
    """One round over the open pieces (number, size) and the gaps (number, size) of the open sequences.

    Rows: piece and sequence_id, slot and room for a match; one side alone for what stays open. None without pieces.
    """
    spark = items.sparkSession
    sizes = items.select(F.lit(0).alias("kind"), "size").unionAll(gaps.select(F.lit(1), "size"))
    counted = np.zeros((2, capacity + 1), np.int64)
    for row in sizes.groupBy("kind", "size").agg(F.count("*").alias("n")).collect():  # two rows a size at most
        counted[row["kind"], row["size"]] = row["n"]
    if not counted[0].any():
        return None
    open_sizes = np.flatnonzero(counted[0])
    least, most = int(open_sizes[0]), int(open_sizes[-1])
    counted[1, :least] = 0  # never of use again
    # At most as many slots as gaps and twice the pieces.
    each = -(-2 * int(counted[0].sum()) // max(1, int(counted[1].sum())))
    slots = F.greatest(F.lit(1), F.least(F.call_function("div", F.col("size"), F.lit(most)).cast("int"), F.lit(min(each, capacity))))
    cut = gaps.filter(F.col("size") >= least).withColumn("slots", slots)
    cut = cut.select("number", "size", "slots", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"))
    last = F.col("size") - (F.col("slots") - 1) * most
    side = cut.select(
        F.lit(1).alias("kind"), F.when(F.col("slot") < F.col("slots") - 1, most).otherwise(last).alias("size"),
        "number", "slot", F.col("size").alias("room"),
    )
    nothing = F.lit(0)
    both = items.select(nothing.alias("kind"), "size", "number", nothing.alias("slot"), nothing.alias("room")).unionAll(side)
    # Equal sizes, which may be a third of all rows, are dealt over several ranges by their numbers.
    order = ["size", "kind", "number", "slot"]
    swept = stored(both.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_sweep, _SWEPT), "bestfit-swept")

    is_gap = F.col("sequence_id").isNotNull()
    alone = swept.filter(F.col("place").isNotNull())
    left = alone.groupBy("part").agg(F.count_if(is_gap).alias("gaps"), F.count_if(~is_gap).alias("pieces")).collect()
    met = between_ranges(sorted(map(tuple, left)), needed(*counted, capacity))  # a few rows a range
    shape = "part int, gap boolean, low bigint, high bigint, pair bigint, step int"
    named = F.broadcast(spark.createDataFrame(met, shape).withColumnRenamed("part", "in_part"))
    here = (F.col("part") == F.col("in_part")) & (is_gap == F.col("gap")) & (F.col("place") >= F.col("low")) & (F.col("place") < F.col("high"))
    told = alone.join(named, here, "left").withColumn("pair", F.col("pair") + F.col("step") * (F.col("place") - F.col("low")))
    row = ["number", "size", "sequence_id", "slot", "room"]
    pairs = told.filter(F.col("pair").isNotNull()).groupBy("pair").agg(*[F.max(c).alias(c) for c in row])
    opened = F.col("in_part").isNotNull()
    rest = told.filter(F.col("pair").isNull()).select(
        "number", "size",
        F.when(opened, F.col("number")).otherwise(F.col("sequence_id")).alias("sequence_id"),
        F.when(opened, 0).otherwise(F.col("slot")).alias("slot"),
        F.when(opened, capacity).otherwise(F.col("room")).alias("room"),
    )
    matched = swept.filter(F.col("place").isNull()).select(*row)
    return stored(matched.unionAll(pairs.select(*row)).unionAll(rest), "bestfit-round")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``number, sequence_id, offset`` for pieces (number, length; lengths from 1 to ``capacity``, numbers unique).

    A sequence is named by the number of the piece that opened it.
    """
    spark = pieces.sparkSession
    items = pieces.filter(F.col("length") < capacity).select(F.col("length").cast("int").alias("size"), "number")
    gaps = spark.createDataFrame([], "number bigint, size int")
    rounds = []
    while (done := _round(items, gaps, capacity)) is not None:
        rounds.append(done.withColumn("round", F.lit(len(rounds))))
        items = done.filter(F.col("sequence_id").isNull()).select("size", "number")
        taken = done.filter(F.col("sequence_id").isNotNull()).groupBy(F.col("sequence_id").alias("number"))
        gaps = taken.agg((F.max("room") - F.coalesce(F.sum("size"), F.lit(0))).cast("int").alias("size")).filter("size > 0")
    whole = pieces.filter(F.col("length") == capacity)
    placed = whole.select("number", F.col("number").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    if rounds:
        joined = rounds[0]
        for one in rounds[1:]:
            joined = joined.unionAll(one)
        # The slots of one sequence in one round: at most `capacity` rows.
        before = W.partitionBy("round", "sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
        offset = F.lit(capacity) - F.col("room") + F.coalesce(F.sum("size").over(before), F.lit(0))
        met = joined.filter(F.col("number").isNotNull() & F.col("sequence_id").isNotNull())
        placed = placed.unionAll(met.select("number", "sequence_id", offset.cast("bigint").alias("offset")))
    return placed


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 2, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece; the ids too, if asked for, from which
    ``packing.sequences`` makes the sequences.

    Null keys and repeated rows keep their rows; a null or empty text is its end id alone; a very long one is many
    pieces; pieces of one length are told apart by their numbers; other columns are ignored; an empty table has no pieces.
    """
    pieces = stored(cut_pieces(docs, path, capacity, end_id, key, text, with_ids), "bestfit-pieces")
    kept = [c for c in pieces.columns if c != "number"]
    return pieces.join(place(pieces, capacity), "number").select(*kept, "sequence_id", "offset")
