from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from trailmill.llm import crosstok, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", None, " ", "a", "  a  b\n\nc", "x<|endoftext|>y <|endoftext|> z", "a b\tc\r\nd  ", "é é 日本語 テスト 123 4", "a\x00b \x1c c",
    "word! word!! (word) wor-d", "a▁b", "▁", "\n", " a", "\na b", "a ", "😀 😀a 👍🏽", "<s> </s> <unk> <0x41>", "=" * 300, "a" * 500,
    "ﬁ ﬀ ½ Å", "the the the of the", "İstanbul ΣΑΣ don't",
]


def brute(rows):
    """Per row (n_a, n_b, n_groups, n_links, n_best, count_sum, groups), with the libraries and plain loops."""
    tok, sp = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    shown = {c: b for b in range(256) for c in [chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 else None] if c}
    shown |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown.values())}
    entry_a = {i: bytes(shown[c] for c in t) for t, i in tok.get_vocab().items() if i < 50256}
    found, counts = [], Counter()
    for text in rows:
        if not text:
            found.append(None)
            continue
        ids_a, ids_b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        bytes_a = [entry_a[i] for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [sp.id_to_piece(i)]]
        whole = (" " + text).encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            found.append(None)
            continue
        groups, a, b, at_a, at_b, i, j = [], [], [], 0, 0, 0, 0
        while i < len(ids_a) or j < len(ids_b):
            if at_a <= at_b:
                a.append(ids_a[i])
                at_a += len(bytes_a[i])
                i += 1
            else:
                b.append(ids_b[j])
                at_b += len(bytes_b[j])
                j += 1
            if at_a == at_b:
                groups.append((a, b))
                a, b = [], []
        found.append((ids_a, ids_b, groups))
        counts.update({(x, y) for a, b in groups for x in a for y in b})
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for one in found:
        if one is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        ids_a, ids_b, groups = one
        links = [(x, y) for a, b in groups for x in a for y in b]
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (len(ids_a), len(ids_b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), told)
        )
    return out


def _rows(df):
    return sorted(
        ((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=str
    )


def _told(rows):
    shown = [(k, *x[:-1], hashlib.sha256(x[-1].encode()).hexdigest() if x[-1] else "") for (k, _), x in zip(rows, brute([t for _, t in rows]))]
    return sorted(shown, key=str)


def test_odd_rows_by_both_ways_of_looking_up(spark, docs_of, monkeypatch):
    monkeypatch.setattr(crosstok, "_SLICE", 200)
    monkeypatch.setattr(crosstok, "_LINKS", 50)
    monkeypatch.setattr(crosstok, "_HELD", 40)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(3, "the of"), (3, "the of"), (None, "the x"), (None, None)]
    docs = docs_of(rows).withColumn("pairs", F.lit(1)).withColumn("row", F.lit("r"))
    for sent in (crosstok.SENT, 0):
        assert _rows(crosstok.align(docs, A, B, sent=sent)) == _told(rows)


def test_groups_on_request_and_empty_tables(spark, docs_of):
    rows = [(1, "The quick 日本"), (2, None)]
    told = brute([t for _, t in rows])
    got = {r.doc_id: r.groups for r in crosstok.align(docs_of(rows), A, B, with_groups=True).collect()}
    assert got == {1: told[0][-1], 2: ""}
    for sent in (crosstok.SENT, 0):
        assert crosstok.align(docs_of([]), A, B, sent=sent).collect() == []
        assert _rows(crosstok.align(docs_of([(1, ""), (2, None)]), A, B, sent=sent)) == _told([(1, ""), (2, None)])


def test_query_over_whole_texts(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert _rows(queries.op12_tokenizer_alignment(spark, folder)) == _told(rows)


@pytest.fixture(scope="module")
def coders():
    return crosstok.SpacedEncoder(A, kept=50), crosstok.SentencePieces(B, kept=50)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBé .,!?\n\t'1(’　|ñ<>日▁=x"), max_size=30), min_size=1, max_size=6))
def test_ids_are_the_libraries(coders, texts):
    a, b = coders
    for coder, told in (
        (a, [x.ids for x in a.tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)]),
        (b, b.processor.encode(texts)),
    ):
        offsets, ids = coder.encode(pa.array(texts, pa.string()))
        got = [ids[x:y].tolist() for x, y in zip(offsets, offsets[1:])]
        assert [g for g, t in zip(got, texts) if t] == [x for x, t in zip(told, texts) if t]


def test_words_are_cut_where_no_piece_crosses(coders):
    assert coders[1].apart


def test_links_are_joined_in_blocks(coders, monkeypatch):
    texts = pa.array(["The quick 日本 =====", "xyzzy 日 the the"] * 3)
    sides = []
    for coder, other in zip(coders, coders[::-1]):
        offsets, ids = coder.encode(texts)
        sides.append(crosstok._Side(offsets, ids, [True] * len(texts), coder.bytes))
    common = sides[0].ends("a").join(sides[1].ends("b"), ["doc", "end"], join_type="inner")
    for side, row in zip(sides, "ab"):
        side.cut(common.column(row).to_numpy())
    keys = [("doc", "ascending"), ("pair", "ascending")]
    whole = crosstok._links(*sides, 32_000).sort_by(keys)
    monkeypatch.setattr(crosstok, "_LINKS", 3)
    assert crosstok._links(*sides, 32_000).sort_by(keys).equals(whole)
