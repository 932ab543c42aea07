"""License scans and decontamination against plain versions of their rules."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest

from pyspark.sql import functions as F

from trailmill.llm import decontaminate, licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def _license(text):
    w, base, places = words(text), set(), []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += found
        base |= {label} if found else set()
    labels, best = set(base), 0.0
    last = max(0, math.ceil((len(w) - licenses.BLOCK) / licenses.STEP))
    for k in range(last + 1):
        block = set(w[k * licenses.STEP : k * licenses.STEP + licenses.BLOCK])
        for label, template in licenses.TEMPLATES:
            t = set(template.split())
            if len(t & block) >= math.ceil(licenses.THRESHOLD * len(t) - 1e-9):
                labels.add(label)
                best = max(best, len(t & block) / len(t))
    ends = (min(places), max(places)) if places else (None, None)
    return (len(w), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if base else best)


def test_licenses(spark, docs_of):
    rng = random.Random(2)
    noise = lambda n: " ".join(rng.choice(["the", "of", "license", "under", "gnu", "by", "cc", "software", "wort"]) for _ in range(n))
    texts = [
        None, "", "..", "CC-BY cc by", "ALL  rights, reserved! all rights", "general public license", "Released under the MIT License.",
        "licensed under apache license 2.0", "Ⓒ all rights reserved", noise(500) + " Licensed under the Apache License, version 2.0 " + noise(40),
        noise(31) + " permission is hereby granted free of charge to any person obtaining a copy of this " + noise(3), "cc by cc by cc",
        *[noise(n) for n in (15, 32, 33, 48, 49, 200)], "word " * 30_000 + "released under mit license",
    ]
    rows = list(enumerate(texts)) + [(None, "all rights reserved"), (5, texts[5]), (5, texts[6])]
    got = licenses.scan(docs_of(rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((k, *_license(t)) for k, t in rows), key=str)
    assert licenses.scan(docs_of([])).count() == 0


def _shares(text, templates, block=32):
    """The largest share of each template that stands in any stretch of so many words, from every place."""
    w, out = words(text), {}
    for label, template in templates:
        t = set(template.split())
        span = max(block, 2 * len(t))
        most = max((len(t & set(w[p : p + span])) / len(t) for p in range(len(w))), default=0.0)
        out[label] = max(most, out.get(label, 0.0))
    return out


def test_notices_are_found_at_every_place(spark, docs_of):
    notice = (
        "Confidential and proprietary. Copyright 2020 Acme Inc. All rights were sold. No part of this document may be reproduced or "
        "transmitted in any form without the prior written permission"
    )
    assert 17 < len(words(notice)) <= 32
    long = [f"term{k}" for k in range(50)]
    templates = (*licenses.TEMPLATES, ("long", " ".join(long)))
    wide = "permission is hereby granted, x x x x x x x x x free of charge, to any person x x x obtaining a copy of this software"
    rows = [(k, "x " * k + notice + " y" * (40 - k)) for k in range(40)]
    rows += [(100 + k, "x " * k + wide + " y" * 50) for k in range(18)]
    rows += [(200 + k, "x " * (37 * k) + " z ".join(long[k:]) + " y" * 70) for k in range(14)]
    rows += [(300, "x " + " z z z z ".join(words(notice))), (301, notice[:60])]
    got = {r.doc_id: r for r in licenses.scan(docs_of(rows), templates).collect()}
    for key, text in rows:
        met = {label: share for label, share in _shares(text, templates).items() if share >= 0.8 - 1e-9}
        assert (got[key].labels, got[key].score) == (",".join(sorted(met)), max(met.values(), default=0.0)), key
    assert all(got[k].labels == "proprietary" for k in range(40)) and got[200].labels == "long" and got[300].labels == ""


def _contamination(text, items):
    w, hit, found = words(text), set(), set()
    for key, item in items:
        i = words(item)
        if not i or key is None:
            continue
        n = min(13, len(i))
        for win in {tuple(i[k : k + n]) for k in range(len(i) - n + 1)}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) == win:
                    hit.update(range(p, p + n))
                    found.add(str(key))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)


def test_contamination(spark, docs_of):
    rng = random.Random(7)
    text = lambda n, of=60: " ".join(f"w{rng.randrange(of)}" for _ in range(n))
    long = text(40)
    items = [(1, long), (10, long), (2, text(13)), (3, "one two three"), (4, "solo"), (5, None), (6, "?!"), (7, "same " * 30), (8, text(12)), (None, text(20))]
    cut = long.split()
    texts = [
        None, "", long, " ".join(cut[:12]), " ".join(cut[:13]), text(300) + " " + " ".join(cut[5:30]) + " " + text(300),
        text(250) + " " + items[2][1].upper(), text(400) + " one, two: three", "one two one two three three", "Solo", "same " * 13, "same " * 12,
        items[8][1], " ".join(f"w{k % 3}" for k in range(600)), text(3000, 4) + " " + long,
    ]
    rows = list(enumerate(texts)) + [(None, long), (3, texts[2]), (3, texts[2])]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contamination(docs_of(rows), table, keep=["doc_id"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((k, *_contamination(t, items)) for k, t in rows), key=str)
    none = decontaminate.contamination(docs_of(rows), table.limit(0), keep=["doc_id"]).collect()
    assert not any(r.n_hit or r.contaminated for r in none)
    assert decontaminate.contamination(docs_of([]), table, keep=["doc_id"]).count() == 0


@pytest.mark.parametrize("sent", [0, decontaminate.BROADCAST_WINDOWS])
def test_benchmarks_of_any_size_give_the_same(spark, docs_of, sent):
    rng = random.Random(9)
    text = lambda n, of=40: " ".join(f"w{rng.randrange(of)}" for _ in range(n))
    items = [(1, " ".join(f"a{k}" for k in range(40))), (2, text(30)), (3, "one two"), (4, "same " * 20), (5, text(30))]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(1, "x " * 300 + items[0][1]), (2, "nothing"), (3, text(200) + items[1][1] + " one two " + "same " * 300), (4, items[4][1]), (5, items[4][1])]
    got = decontaminate.contamination(docs_of(rows), table, keep=["doc_id"], sent=sent).collect()
    assert sorted(map(tuple, got)) == [(k, *_contamination(t, items)) for k, t in rows]


def test_a_large_benchmark_is_joined_by_shuffle_and_the_documents_read_as_often_as_with_a_small_one(spark, docs_of, tmp_path):
    docs_of([(k, f"a b c d e f g h i j k l m n o p {k}") for k in range(50)]).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs").selectExpr("sha2(text, 256) AS key", "text")
    table = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p q r s t u v")], "item_id bigint, text string")
    windows, _ = decontaminate.benchmark_windows(table)
    plans = [decontaminate.hit_windows(docs, windows, sent)._jdf.queryExecution().executedPlan().toString() for sent in (0, 100)]
    assert "BroadcastHashJoin" in plans[1] and "BroadcastHashJoin" not in plans[0]
    assert [p.count("/docs") for p in plans] == [1, 1]  # the hashes were a scan of their own, whatever the number of windows


def test_rows_keep_columns_of_any_name(spark, docs_of):
    docs = docs_of([(1, "one two three"), (None, None)]).withColumns({n: F.lit(n) for n in ("n_hit", "contaminated", "__key", "key", "row")})
    table = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    whole = decontaminate.contamination(docs, table, whole=True).select("row.*", "contaminated")
    assert whole.columns == [*docs.columns, "contaminated"]
    found = {r.doc_id: r for r in decontaminate.contamination(docs, table).collect()}
    assert found[1].contaminated is True and found[1].key == "key" and found[None].n_words == 0 and found[1]["__key"] == "__key"


def test_native_plans(spark, docs_of):
    rows = docs_of([(1, "all rights reserved")])
    table = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    for found in (licenses.scan(rows), decontaminate.contamination(rows, table, keep=["doc_id"])):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|InArrow", plan)


def test_a_text_is_split_into_words_once_for_its_windows(spark, docs_of):
    docs = docs_of([(1, "a b c d e f g h i j k l m n"), (2, ""), (3, "?!"), (4, None)]).selectExpr("doc_id AS key", "text")
    table = spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "item_id bigint, text string")
    found = decontaminate.hit_windows(docs, decontaminate.benchmark_windows(table)[0])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("array_remove(split(") == 1
    assert sorted((r.key, r.start) for r in found.collect()) == [(1, 0), (1, 1)]
