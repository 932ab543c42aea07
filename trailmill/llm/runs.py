"""Periodic runs of words, by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart are the same), of at least
``max(6, 4 * q)`` words, that no neighbouring word extends. Basic factors are the stretches of 1, 2, 4, ... words;
equal ones of a document share a name, and a name of 2 ** (k + 1) words is the pair of the names of its halves.
For each length, the successor of an occurrence is the next one of its name. Where three successive occurrences
lie at one distance d, half the factor's length < d <= the factor's length, they form an arithmetic progression within twice
that length and propose the period d. Each period belongs to one length alone.

A progression from i covers 2 * d + 2 ** k words with smallest period d: a nearer occurrence would be a successor.
Any run holds such progressions from its first word on, and neighbouring ones of one period overlap by more than
the period, so the union of neighbours is extended as far as the period goes, and is found once.
Names that occur once take no part in longer factors, so ordinary text costs little beyond its pairs of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import lean, slices

# White space that separates words, and the least repetitions and words of a run.
SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
REPEATS, LEAST = 4, 6

_SPACED = np.arange(256, dtype=np.uint8)
_SPACED[list(SPACE)] = 0x20
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Bounds of each text's words, and all words. A null text has none."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    even = pa.StringArray.from_buffers(len(texts), pa.py_buffer((ends - ends[0]).astype(np.int32)), pa.py_buffer(_SPACED[raw]))
    lists = pc.split_pattern(even, " ")
    flat = lists.flatten()
    held = np.asarray(pc.greater(pc.binary_length(flat), 0))
    counted = np.concatenate([[0], np.cumsum(held, dtype=np.int64)])
    return counted[np.asarray(lists.offsets)], flat.filter(pa.array(held))


def repeat_tails(bounds: np.ndarray, seeds: np.ndarray, seeded: np.ndarray) -> np.ndarray:
    """Which word stands at each place once the tails of the ``seeded`` texts repeat: with g the seed and n words, from
    word a = g % n on the p = 1 + (n - a) // (3 + g % 8) words there, over and over."""
    place = np.arange(bounds[-1])
    for k in np.flatnonzero(seeded & (np.diff(bounds) > 0)):
        first, n, g = int(bounds[k]), int(bounds[k + 1] - bounds[k]), int(seeds[k])
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        place[first + a : first + n] = first + a + np.arange(n - a) % p
    return place


def _by_name(key: np.ndarray) -> np.ndarray:
    """The order that sorts by name, then by place."""
    bits = len(key).bit_length()
    if int(key.max()).bit_length() + bits > 63:
        return np.argsort(key, kind="stable")
    return np.sort(key << bits | np.arange(len(key))) & ((1 << bits) - 1)


def find_runs(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs, by start and period; equal words have equal codes, from 0 on.

    Starts count over all texts together.
    """
    n, sizes = len(codes), np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    at, reach, proposed = np.arange(n), 1, []
    key = text * (int(codes.max()) + 1 if n else 1) + codes
    name, named = np.full(n, -1), at  # of factors that occur again
    while len(at):
        order = _by_name(key)
        place, key = at[order], key[order]
        same = key[1:] == key[:-1]
        step = np.diff(place)
        hits = np.flatnonzero(
            same[:-1] & same[1:] & (step[:-1] == step[1:]) & (step[:-1] <= reach) & (step[:-1] > reach // 2)
        )
        proposed.append((place[hits], step[hits], np.full(len(hits), reach)))
        group = np.concatenate([[0], np.cumsum(~same)])
        live = np.bincount(group)[group] > 1
        name[named] = -1
        named = np.sort(place[live])
        name[place[live]] = group[live]
        at = named[named + reach < n]
        second = name[at + reach]
        held = (second >= 0) & (text[at] == text[at + reach])
        at = at[held]
        key = name[at] * (int(group[-1]) + 1) + second[held]
        reach *= 2
    if not proposed:
        return (np.zeros(0, np.int64),) * 4
    place, step, reach = map(np.concatenate, zip(*proposed))
    order = np.lexsort((place, step))
    place, step, reach = place[order], step[order], reach[order]
    if not len(place):
        return (np.zeros(0, np.int64),) * 4
    first = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 1) | (np.diff(step) != 0)]))
    last = np.append(first[1:], len(place)) - 1
    start, period = place[first], step[first]
    length = place[last] - start + 2 * period + reach[first]
    long = length >= np.maximum(LEAST, REPEATS * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    return text[start], start, length, period


def _repeated(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether any run holds a word after that run's first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change)[:-1] > 0


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: Column | None = None) -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length, period; by start, then period) and collapsed, the words that no
    run holds after its first period, joined by a space.

    With ``seed``, rows where it is not null have their words rewritten first (:func:`repeat_tails`). A null or empty
    text has no words, no run and an empty ``collapsed``; null keys and repeated rows keep their rows; a very long text is
    one task's work, in memory proportional to its words; other columns are ignored; an empty table gives no rows.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                bounds, words = split_words(part.column("text"))
                seeds = part.column("seed")
                if seeds.null_count < len(seeds):
                    place = repeat_tails(bounds, np.asarray(seeds.fill_null(0)), np.asarray(seeds.is_valid()))
                    words = words.take(pa.array(place))
                codes = np.asarray(words.dictionary_encode().indices).astype(np.int64)
                owner, start, length, period = find_runs(codes, bounds)
                kept = ~_repeated(len(codes), start, length, period)
                left = np.concatenate([[0], np.cumsum(kept, dtype=np.int32)])[bounds]
                lists = pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(kept)))
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(part)))])
                runs = pa.StructArray.from_arrays(
                    [pa.array(x, pa.int64()) for x in (start - bounds[owner], length, period)], fields=list(_RUN)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
                        pc.binary_join(lists, " "),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(
        docs[key].cast("bigint").alias("key"),
        docs[text].cast("string").alias("text"),
        (F.lit(None) if seed is None else seed).cast("bigint").alias("seed"),
    )
    shape = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return rows.mapInArrow(lean(find), shape)


def digests(found: DataFrame) -> DataFrame:
    """Per row of :func:`periodic_runs`: the number of runs, the longest one (ties: first start, then period) and hashes."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    longest = found.withColumn("best", best)
    length, period = F.col("best.n"), -F.col("best.q")
    return longest.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.call_function("div", 1000 * length, period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
