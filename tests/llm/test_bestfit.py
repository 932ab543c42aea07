from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from trailmill.llm import bestfit, packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _stack(gaps):
    """Matches by a plain stack, and what stays open."""
    held, pairs, alone = [], [], []
    for i, gap in enumerate(gaps):
        if not gap:
            held.append(i)
        elif held:
            pairs.append((held.pop(), i))
        else:
            alone.append(i)
    return sorted(pairs), alone, held


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), max_size=40))
def test_matches_of_one_range(gaps):
    got = bestfit.match(np.array(gaps, bool))
    assert sorted(zip(*(x.tolist() for x in got))) == _stack(gaps)[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.booleans(), max_size=12), max_size=6), st.integers(0, 5))
def test_matches_between_ranges(ranges, fresh):
    """Ranges matched alone and then between each other give what one stack gives over all of them."""
    whole = [(k, i) for k, r in enumerate(ranges) for i in range(len(r))]
    pairs, _, held = _stack([x for r in ranges for x in r])
    got, left, counts = [], {}, []
    for k, r in enumerate(ranges):
        own, gaps, pieces = _stack(r)
        got += [((k, a), (k, b)) for a, b in own]
        left |= {(k, True, n): (k, i) for n, i in enumerate(gaps)} | {(k, False, n): (k, i) for n, i in enumerate(pieces)}
        counts.append((k, len(gaps), len(pieces)))
    met, opened = {}, []
    for part, gap, low, high, pair, step in bestfit.between_ranges(counts, fresh):
        for x in range(low, high):
            if pair is None:
                opened.append(left[part, gap, x])
            else:
                met.setdefault(pair + step * (x - low), {})[gap] = left[part, gap, x]
    got += [(x[False], x[True]) for x in met.values()]
    assert sorted(got) == sorted((whole[a], whole[b]) for a, b in pairs)
    assert sorted(opened) == sorted(whole[i] for i in held[len(held) - min(fresh, len(held)):])


def _decreasing(lengths, capacity):
    """How many sequences best fit takes, the longest piece first."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def _placed(spark, lengths, capacity):
    pieces = spark.createDataFrame(list(enumerate(lengths)), "number bigint, length bigint").repartition(5)
    rows = bestfit.place(pieces, capacity).collect()
    assert sorted(r.number for r in rows) == list(range(len(lengths)))
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, lengths[r.number]))
    for parts in held.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(held)


RNG = np.random.default_rng(3)
LENGTHS = {
    "any": RNG.integers(1, 65, 400).tolist(),
    "one size": [22] * 300,
    "large": RNG.integers(33, 64, 80).tolist(),
    "units": [1] * 500,
    "a hot size": [7] * 200 + RNG.integers(1, 65, 200).tolist(),
    "whole": [64] * 5,
    "large then units": [40] * 20 + [1] * 300,
}


@pytest.mark.parametrize("name", LENGTHS)
def test_nearly_as_few_sequences_as_best_fit_decreasing(spark, name):
    lengths = LENGTHS[name]
    used, bound = _placed(spark, lengths, 64), -(-sum(lengths) // 64)
    assert bound <= used <= max(_decreasing(lengths, 64) * 1.03, _decreasing(lengths, 64) + 1)


def test_bounds_never_ask_for_more_than_are_needed():
    items, gaps = np.zeros(65, np.int64), np.zeros(65, np.int64)
    items[22] = 300
    assert bestfit.needed(items, gaps, 64) == 150  # two of them in each, not three
    gaps[44] = 150
    assert bestfit.needed(items, gaps, 64) == 0
    items[:] = gaps[:] = 0
    items[40], items[1] = 20, 300
    assert bestfit.needed(items, gaps, 64) == 20


def _check(rows, texts, capacity):
    told = Tokenizer.from_file(PATH)
    ids = {k: [*x.ids, 2] for (k, _), x in zip(texts, told.encode_batch([t or "" for _, t in texts], add_special_tokens=False))}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == ids.keys()
    for key, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        total, at = len(ids[key]), 0
        assert [r.piece for r in pieces] == list(range(-(-total // capacity)))
        for r in pieces:
            assert r.start == at and (r.piece == 0 or r.length == capacity)
            own = np.array(ids[key][at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(own)
            at += r.length
        assert at == total
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity


def test_query_places_every_piece(spark, docs_of, tmp_path):
    rng = np.random.default_rng(1)
    texts = [(k, " ".join(rng.choice(["alpha", "beta", "x1", "ĝ", "the"], int(n)))) for k, n in enumerate(rng.integers(0, 900, 60))]
    texts += [(100, None), (101, ""), (102, "a b " * 3000), (None, "lone words"), (103, "<|endoftext|> x")]
    docs_of(texts).withColumn("sequence_id", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op11_best_fit(spark, str(tmp_path)).collect()
    _check(rows, texts, 1024)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= -(-total // 1024) + 2


def test_repeated_rows_empty_table_and_sequences(spark, docs_of):
    docs = docs_of([(1, "a b c"), (1, "a b c"), (1, None)])
    placed = bestfit.pack_documents(docs, PATH, capacity=4, with_ids=True)
    assert sorted((r.doc_id, r.length) for r in placed.collect()) == [(1, 1), (1, 4), (1, 4)]
    whole = packing.sequences(placed, 4).collect()
    assert sorted(len(r.ids) for r in whole) == [1, 4, 4]
    assert bestfit.pack_documents(docs.limit(0), PATH).collect() == []
