"""Packing documents into fixed-length sequences as a cutting-stock problem.

Documents longer than a sequence are cut into full pieces and a remainder. Piece lengths, rounded up to
classes, form a histogram of bounded size. A linear program over patterns (how many pieces of each class
share a sequence) is solved by column generation: a knapsack dynamic program prices new patterns from
the program's dual values. The program's counts are rounded down, the rest of the histogram is packed
best-fit, and the patterns are then dealt to the pieces by their rank within each class. Only the
histogram visits the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from . import tokens
from .common import lean, slices, stored
from .pfor import with_end

CAPACITY = 4096
GRAIN = 16
SLICE_BYTES = 4_000_000


# ---- the linear program -------------------------------------------------------------------------
@dataclass
class Plan:
    """``patterns[p, c]`` pieces of class c in each of ``counts[p]`` sequences."""

    patterns: np.ndarray
    counts: np.ndarray


def price(values: np.ndarray, sizes: np.ndarray, room: int, most: np.ndarray) -> tuple[float, np.ndarray]:
    """The best pattern for the dual values: knapsack over the room, ``sizes`` in grains.

    ``most`` bounds nothing here but classes without demand, which are left out.
    """
    use = np.flatnonzero((values > 1e-12) & (most > 0))
    best = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        fit = use[sizes[use] <= c]
        if len(fit):
            gains = values[fit] + best[c - sizes[fit]]
            k = int(np.argmax(gains))
            if gains[k] > best[c] + 1e-12:
                best[c], choice[c] = gains[k], fit[k]
    pattern, c = np.zeros(len(sizes), np.int64), room
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            pattern[choice[c]] += 1
            c -= sizes[choice[c]]
    return float(best[room]), pattern


def solve(demand: np.ndarray, sizes: np.ndarray, room: int, rounds: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """Column generation by the revised simplex method: (basis patterns as columns, their amounts).

    Starts from one pattern for each class, filled with that class alone. ``rounds`` bounds the work; the basis is
    feasible after any round, so stopping early costs padding, never correctness.
    """
    n = len(sizes)
    alone = room // sizes
    basis = np.diag(alone).astype(float)
    inverse = np.diag(1.0 / alone)
    amount = demand / alone
    for k in range(rounds):
        duals = inverse.sum(axis=0)  # every pattern costs one sequence
        worth, pattern = price(duals, sizes, room, demand)
        if worth <= 1 + 1e-7:
            break
        entering = inverse @ pattern
        positive = np.flatnonzero(entering > 1e-10)
        ratios = amount[positive] / entering[positive]
        out = positive[np.argmin(ratios)]
        step = ratios.min()
        amount = amount - step * entering
        amount[out] = step
        amount[amount < 0] = 0
        basis[:, out] = pattern
        pivot = inverse[out] / entering[out]
        inverse = inverse - np.outer(entering, pivot)
        inverse[out] = pivot
        if k % 200 == 199:
            inverse = np.linalg.inv(basis)
            amount = np.maximum(inverse @ demand, 0)
    return basis.astype(np.int64), amount


def make_plan(demand: np.ndarray, sizes: np.ndarray, room: int) -> Plan:
    """Whole-number patterns that use every piece of the histogram exactly once."""
    live = np.flatnonzero(demand > 0)
    if not len(live):
        return Plan(np.zeros((0, len(sizes)), np.int64), np.zeros(0, np.int64))
    basis, amount = solve(demand[live].astype(float), sizes[live], room)
    found: dict[bytes, int] = {}
    rest = demand[live].astype(np.int64).copy()
    for k in np.argsort(-amount, kind="stable"):
        pattern = basis[:, k]
        used = pattern > 0
        times = int(min(np.floor(amount[k] + 1e-6), (rest[used] // pattern[used]).min())) if used.any() else 0
        if times > 0:
            rest -= times * pattern
            found[pattern.tobytes()] = found.get(pattern.tobytes(), 0) + times
    # What rounding left is at most a few pieces for each class: largest first, filled best-fit, the
    # same pattern repeated while it lasts.
    while rest.any():
        pattern, left = np.zeros(len(live), np.int64), room
        for c in np.argsort(-sizes[live], kind="stable"):
            take = min(int(rest[c]), left // int(sizes[live][c]))
            pattern[c] = take
            left -= take * int(sizes[live][c])
        used = pattern > 0
        times = int((rest[used] // pattern[used]).min())
        rest -= times * pattern
        found[pattern.tobytes()] = found.get(pattern.tobytes(), 0) + times
    patterns = np.zeros((len(found), len(sizes)), np.int64)
    patterns[:, live] = [np.frombuffer(x, np.int64) for x in found]
    return Plan(patterns, np.fromiter(found.values(), np.int64, len(found)))


# ---- pieces ---------------------------------------------------------------------------------------
def token_pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
    slice_bytes: int = SLICE_BYTES,
    remembered: int = tokens.KEPT,
) -> DataFrame:
    """Each document's ids with ``end_id``, cut every ``capacity`` ids: doc_id, start, length, ids_crc32,
    doc_tokens, and the ids themselves on request. A null text is empty and has the end id alone.

    A worker encodes about ``slice_bytes`` of text at a time and remembers so many pieces: less memory, more time.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.encoder(path, remembered)
        for batch in batches:
            for part in slices(batch, "text", slice_bytes):
                offsets, ids = with_end(*coder.encode(part.column("text")), end_id)
                total = np.diff(offsets)
                pieces = -(-total // capacity)
                row = np.repeat(np.arange(len(total)), pieces)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth * capacity
                length = np.minimum(total[row] - start, capacity)
                at = offsets[row] + start
                raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
                columns = [
                    part.column("key").take(pa.array(row)),
                    pa.array(start),
                    pa.array(length),
                    pa.array([zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at, length)], pa.int64()),
                    pa.array(total[row]),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(np.append(at, len(ids)).astype(np.int32), ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    shape = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * with_ids
    rows = docs.select(docs[key].cast("bigint").alias("key"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(lean(cut), shape)


# ---- placing --------------------------------------------------------------------------------------
def place(pieces: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """``pieces`` (doc_id, start, length, …; each length from 1 to ``capacity``) with sequence_id and offset.

    Deterministic up to rows that agree in every column used here. Pieces of one class are ranked within
    key ranges, never in one task: a class may hold a third of all rows.
    """
    if capacity % grain:
        raise ValueError("the grain must divide the capacity")
    room = capacity // grain
    ranked = stored(_local_ranks(pieces, grain), "packing-pieces")
    # At most a row for each key range and class; the totals are the histogram.
    per_part = ranked.groupBy("part", "class").agg(F.count("*").alias("n"))
    before = W.partitionBy("class").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_part.select("part", "class", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    demand = np.zeros(room, np.int64)
    for row in per_part.groupBy("class").agg(F.sum("n").alias("n")).collect():  # `room` rows at most
        demand[row["class"] - 1] = row["n"]
    plan = make_plan(demand, np.arange(1, room + 1), room)
    table = _segments(plan)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, rank = np.asarray(batch.column("class")), np.asarray(batch.column("rank"))
            sequence, slot = _slots(table, kind, rank)
            kept = [batch.column(n) for n in names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(slot)], names=names)

    joined = ranked.join(offsets, ["part", "class"]).withColumn("rank", F.col("base") + F.col("local"))
    names = [*pieces.columns, "sequence_id", "slot"]
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    dealt = joined.select(*pieces.columns, "class", "rank").mapInArrow(deal, f"{shape}, sequence_id bigint, slot bigint")
    # A sequence has at most `capacity` pieces.
    within = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    return dealt.withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0))).drop("slot")


def _local_ranks(pieces: DataFrame, grain: int) -> DataFrame:
    """Adds class, part (the key range) and local, the rank among the range's pieces of the class."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            kind = -(-np.asarray(batch.column("length")) // grain)
            order = np.argsort(kind, kind="stable")
            values, first, counts = np.unique(kind[order], return_index=True, return_counts=True)
            local = np.empty(len(kind), np.int64)
            base = np.array([seen.get(int(v), 0) for v in values], np.int64)
            local[order] = np.arange(len(kind)) - np.repeat(first, counts) + np.repeat(base, counts)
            seen.update((int(v), int(b + c)) for v, b, c in zip(values, base, counts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(kind.astype(np.int32)), pa.array(np.full(len(kind), part, np.int32)), pa.array(local)],
                names=[*batch.schema.names, "class", "part", "local"],
            )

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    order = ["doc_id", "start", "length"]
    ranges = pieces.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranges.mapInArrow(rank, f"{shape}, class int, part int, local bigint")


def _segments(plan: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """For each class, which ranks go to which pattern: first rank, pieces in a sequence, first sequence,
    first slot. As many rows as the patterns have classes."""
    base = np.cumsum(plan.counts) - plan.counts
    table = {}
    for c in range(plan.patterns.shape[1]):
        used = np.flatnonzero(plan.patterns[:, c])
        if len(used):
            each = plan.patterns[used, c]
            ranks = each * plan.counts[used]
            slots = plan.patterns[used, :c].sum(axis=1)
            table[c + 1] = (np.cumsum(ranks) - ranks, each, base[used], slots)
    return table


def _slots(table, kind: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sequence, slot = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
    for c in np.unique(kind):
        rows = np.flatnonzero(kind == c)
        first, each, base, start = table[int(c)]
        k = np.searchsorted(first, rank[rows], side="right") - 1
        nth = rank[rows] - first[k]
        sequence[rows] = base[k] + nth // each[k]
        slot[rows] = start[k] + nth % each[k]
    return sequence, slot


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
    slice_bytes: int = SLICE_BYTES,
    remembered: int = tokens.KEPT,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for every piece.

    Null keys and repeated rows keep their rows; other columns are ignored; an empty table has no pieces.
    """
    # Written before it is sorted into key ranges: finding the ranges would otherwise encode every text once more.
    return place(stored(token_pieces(docs, path, capacity, end_id, key, text, False, slice_bytes, remembered), "packing-tokens"), capacity)


def sequences(placed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The token sequences of placed pieces that carry ``ids``: sequence_id, used, ids.

    Padded with ``pad_id`` to ``capacity``, unless the length is a power of two.
    """
    whole = placed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("used")
    )
    used = F.col("used").cast("int")
    ids = F.flatten(F.transform("parts", lambda p: p["ids"]))
    padding = F.when(F.bit_count("used") == 1, 0).otherwise(F.lit(capacity) - used)
    return whole.select("sequence_id", "used", F.concat(ids, F.array_repeat(F.lit(pad_id), padding)).alias("ids"))
