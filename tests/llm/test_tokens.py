from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from trailmill.llm import packing, pfor, tokencount, tokens

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ODD = [
    "", None, " ", "  a  b\n\nc", "İstanbul ΣΑΣ don't '' ''s he'll", "x<|endoftext|>y <|endoftext|> z", "a b\tc\r\nd  ",
    "é é 日本語 テスト 123 4", "a\x00b \x1c c", "word! word!! (word) wor-d", "ǅ ß SS ſ", "\n", "a ", " a", "a\n b", "'s 's' IT'S",
    "😀 😀a 👍🏽", "(a). b.. c,d e.\nf", "a" * 3000, "Ab, cD; e.",
]
texts = st.text(st.sampled_from("aBé .,!?\n\t'1(’　|ñ"), max_size=30)


@pytest.fixture(scope="module", params=FILES)
def coder(request):
    return tokens.PieceEncoder(public_tokenizers.path(request.param), kept=40)


def _library(coder, found):
    return [x.ids for x in coder.tokenizer.encode_batch([t or "" for t in found], add_special_tokens=False)]


def _encoded(coder, found):
    offsets, ids = coder.encode(pa.array(found, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def test_ids_are_the_librarys(coder):
    for _ in range(2):
        assert _encoded(coder, ODD) == _library(coder, ODD)


@settings(max_examples=60, deadline=None)
@given(found=st.lists(texts, max_size=6))
def test_ids_of_any_texts(coder, found):
    assert _encoded(coder, found) == _library(coder, found)


@pytest.mark.parametrize("file", FILES)
def test_whole_tokens_are_proven_and_counts_agree(file):
    path = public_tokenizers.path(file)
    whole = tokencount.whole_tokens(path)
    counter = tokencount.Counter(path, whole, kept=40)
    assert len(whole) > 30_000
    assert counter.count(pa.array(ODD, pa.string())).tolist() == [len(x) for x in _library(counter.encoder, ODD)]
    before = counter.merged
    assert counter.count(pa.array(["the and of" if "word" in file else " the and of"])).sum() >= 3
    assert counter.merged - before <= 1  # nothing but the empty piece: whole tokens are not merged


def test_token_counts_of_odd_rows(spark, docs_of):
    path = public_tokenizers.path(FILES[0])
    rows = [(1, None), (None, "two words"), (1, ""), (3, "word " * 3000), (3, "word " * 3000)]
    got = tokencount.token_counts(docs_of(rows), path).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, 0, 0, False), (None, 9, 2, False), (1, 0, 0, False), (3, 15000, 3000, True), (3, 15000, 3000, True)], key=str
    )
    assert tokencount.token_counts(docs_of([]), path).count() == 0


@settings(max_examples=40, deadline=None)
@given(ids=st.lists(st.integers(0, 2**32 - 1), max_size=400), small=st.lists(st.integers(0, 300), max_size=400))
def test_blocks_round_trip(ids, small):
    found = np.array(small + ids + small, "<u4")
    data, starts = pfor.pack(found)
    assert pfor.unpack(data, starts)[: len(found)].tolist() == found.tolist()


def test_exceptions_are_stored_apart():
    ids = np.full(128, 7, "<u4")
    ids[5] = 2**32 - 1
    data, _ = pfor.pack(ids)
    assert len(data) == 6 + 5  # width 0, one exception


def test_token_files_round_trip(spark, docs_of, tmp_path):
    path = public_tokenizers.path(FILES[1])
    rows = [(5, "five " * 500), (2, None), (None, "nobody"), (2, "two"), (9, ""), (2, "two")]
    manifest = pfor.write_tokens(docs_of(rows), path, f"file://{tmp_path}/t")
    got = sorted(pfor.read_tokens(manifest).collect(), key=lambda r: r.start)
    coder = tokens.PieceEncoder(path)
    want = {t: ids + [2] for t, ids in zip([t for _, t in rows], _library(coder, [t for _, t in rows]))}
    assert [r.doc_id for r in got] == [None, 2, 2, 2, 5, 9]
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    assert sorted(map(tuple, (r.ids for r in got))) == sorted(tuple(want[t]) for _, t in rows)
    reader = pfor.Reader(manifest.orderBy("before").first().file)
    offsets, ids = reader.documents(0, 1)
    assert ids.tolist() == got[0].ids
    empty = pfor.write_tokens(docs_of([]), path, f"file://{tmp_path}/e")
    assert pfor.read_tokens(empty).count() == 0


# ---- packing ----------------------------------------------------------------------------------------
def _brute_bound(demand, room):
    return -(-int((demand * np.arange(1, room + 1)).sum()) // room)


@settings(max_examples=25, deadline=None)
@given(demand=st.lists(st.integers(0, 40), min_size=1, max_size=12))
def test_plans_use_every_piece_once(demand):
    demand = np.array(demand)
    plan = packing.make_plan(demand, np.arange(1, len(demand) + 1), len(demand))
    sizes = np.arange(1, len(demand) + 1)
    assert ((plan.patterns * plan.counts[:, None]).sum(axis=0) == demand).all() if len(plan.counts) else not demand.any()
    assert not len(plan.counts) or (plan.patterns @ sizes).max() <= len(demand)


def test_column_generation_beats_first_fit():
    demand = np.zeros(100, int)
    demand[[46, 36, 26, 24]] = [300, 300, 300, 300]
    plan = packing.make_plan(demand, np.arange(1, 101), 100)
    assert plan.counts.sum() <= _brute_bound(demand, 100) * 1.08 + 4


def test_packed_documents(spark, docs_of):
    path = public_tokenizers.path(FILES[0])
    rows = [(k, "word " * n) for k, n in enumerate([0, 1, 5000, 9000, 4095, 4096, 300, 300, 2047, 700] * 4)]
    rows += [(None, "nobody"), (7, None), (3, "word " * 9000)]
    pieces = packing.token_pieces(docs_of(rows), path, with_ids=True)
    got = packing.place(pieces).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        assert r.length == len(r.ids) <= 4096 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for (_, total), found in by_doc.items():
        assert sum(n for _, n in found) % total == 0
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(len((t or "").split()) + 1 for _, t in rows)
    assert sum(r.length for r in got) == total
    assert len(by_sequence) <= 1.15 * total / 4096 + 2
    whole = packing.sequences(packing.place(pieces)).collect()
    assert {len(r.ids) for r in whole if r.used.bit_count() != 1} <= {4096}
    assert packing.pack_documents(docs_of([]), path).count() == 0
