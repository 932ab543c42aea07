from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from trailmill.llm import queries, runs


def brute(words):
    """(start, length, period) of every run, by comparing each stretch with itself."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            found.setdefault((i, j - i + q), q)  # the smallest period of a stretch is met first
            i = j
    return sorted((s, n, q) for (s, n), q in found.items() if n >= max(6, 4 * q))


def rewritten(words, g):
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 == 0 and words:
        words = rewritten(words, h // 10)
    found = brute(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (key, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines), sha(left))


def _found(texts):
    words = [w for t in texts for w in t]
    codes = np.unique(np.array(words, object).astype(str), return_inverse=True)[1].astype(np.int64) if words else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    owner, start, length, period = runs.find_runs(codes, bounds)
    return [[(int(s - bounds[k]), int(n), int(q)) for o, s, n, q in zip(owner, start, length, period) if o == k] for k in range(len(texts))]


block = st.tuples(st.text("ab", min_size=1, max_size=5), st.integers(1, 9)).map(lambda x: x[0] * x[1])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(block, st.text("abc", max_size=6)), max_size=6).map("".join), min_size=1, max_size=4))
def test_runs_of_any_words(texts):
    assert _found(texts) == [brute(t) for t in texts]


def test_long_periods_and_neighbouring_texts():
    rng = np.random.default_rng(5)
    texts = []
    for q in (1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 33, 100):
        unit = [f"u{x}" for x in rng.integers(0, 50, q)]
        for times in (3, 4, 5, 9):
            tail = (unit * (times + 1))[: q * times + int(rng.integers(0, q))]
            texts.append([f"x{len(texts)}", *tail, "y"])
    texts += [["a"] * 3, ["a"] * 3, ["a"] * 5, ["a"] * 6, [], ["a"] * 700]
    assert _found(texts) == [brute(t) for t in texts]


def test_names_too_wide_to_pack(monkeypatch):
    wide = np.array([2**60, 5, 2**60, 5], np.int64)
    assert runs._by_name(wide).tolist() == [1, 3, 0, 2]


def test_words_are_split_at_the_given_characters():
    bounds, words = runs.split_words(pa.array(["\ta b\x0b\x0cc\n", None, "", " ", "\x1cé x  y"]).slice(0))
    assert bounds.tolist() == [0, 3, 3, 3, 3, 5]
    assert words.to_pylist() == ["a", "b", "c", "\x1cé x", "y"]
    assert runs.split_words(pa.array(["q", "a b", "c"]).slice(1))[1].to_pylist() == ["a", "b", "c"]


def test_query_follows_the_rule_on_odd_rows(spark, docs_of, tmp_path):
    planted = [k for k in range(400) if zlib.crc32(str(k).encode()) % 10 == 0]
    plain = next(k for k in range(400) if k not in planted)
    long = " ".join(f"w{i % 997}" for i in range(30_000))
    rows = [(k, " ".join(f"w{(i * i) % 37}" for i in range(7 + 5 * k))) for k in planted[:12]]
    rows += [(planted[13], ""), (planted[14], None), (planted[15], "one"), (planted[16], long), (plain, long)]
    rows += [(None, "a b a b a b a b a"), (None, None), (plain, "x x x x x x"), (plain, "x x x x x x"), (plain, "a  a a\na\ta")]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    cheap = [(k, t) for k, t in rows if t != long]
    told = sorted((expected(k, t) for k, t in cheap), key=str)
    assert [r for r in got if r in set(told)] == told
    periodic = next(r for r in got if r[0] == plain and r[3] == 30_000)
    assert periodic[1:6] == (1, 0, 30_000, 997, 30_090)


def test_empty_table_and_rows_of_the_operator(spark, docs_of):
    docs = docs_of([(1, "p q p q p q p q z"), (1, None)]).withColumn("runs", F.lit("x"))
    got = {(r.doc_id, r.n_words): ([tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(docs).collect()}
    assert got == {(1, 9): ([(0, 8, 2)], "p q z"), (1, 0): ([], "")}
    assert runs.digests(runs.periodic_runs(docs.limit(0))).collect() == []
