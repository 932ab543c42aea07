from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from trailmill.llm import langid


def _brute(text: str, known: str, segment: int) -> int:
    count = 0
    for at in range(0, len(text), segment):
        part, i = text[at : at + segment], 0
        while i < len(part):
            n = 1
            while i + n < len(part) and part[i : i + n + 1] in known:
                n += 1
            i, count = i + n, count + 1
    return count


def _plain(text: str) -> str:
    return "".join(map(chr, langid.normalised(langid._codes_of_text(text.lower())))) if text else ""


@pytest.mark.parametrize("segment", [7, 1024])
def test_phrases_are_the_longest_matches(segment):
    rng = random.Random(3)
    make = lambda n: "".join(rng.choice("abcé d. ") for _ in range(n))
    model = langid.Model(["x", "y"], [make(300), make(80)], segment)
    texts = ["", "123", "a", "  ", "a\nb", "zzz q", *[make(n) for n in (5, 40, 200)]]
    found, letters = langid.Parser(model).phrases(texts)
    for i, text in enumerate(texts):
        want = [_brute(_plain(text), _plain(known), segment) for known in model.texts]
        assert found[:, i].tolist() == want, text
        assert letters[i] == sum(c.isalpha() for c in text)


def _expected(text, model):
    """lang_pred and score by parsing with plain string search."""
    plain = _plain(text)
    if not any(map(str.isalpha, plain)):
        return "und", 0.0
    costs = [_brute(plain, _plain(known), model.segment) * math.log2(max(len(_plain(known)), 2)) for known in model.texts]
    best = min(range(len(costs)), key=lambda k: costs[k])
    second = min(c for k, c in enumerate(costs) if k != best)
    return model.languages[best], second / (costs[best] + second)


def test_predictions_and_scores_are_those_of_the_plain_parse(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.train(docs, F.col("doc_id") % 3 != 1)
    model = langid.Model(model.languages, [t[:1500] for t in model.texts], 97)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model, keep=["doc_id"]).collect()}
    for r in docs.where("n_chars < 1500").collect():
        lang, score = _expected(r.text, model)
        assert got[r.doc_id][0] == lang and abs(got[r.doc_id][1] - score) < 1e-12, r.doc_id


def test_scripts_of_thousands_of_letters_are_told_apart(spark):
    rng = random.Random(11)
    han = [chr(0x4E00 + k) for k in range(3000)]
    kana = [chr(c) for c in range(0x3041, 0x3097)]
    word = {
        "zh": lambda: "".join(rng.sample(han[:2200], 2)),
        "ja": lambda: rng.choice(han[1500:]) + "".join(rng.sample(kana, 2)),
        "en": lambda: rng.choice("the cat sat on mat and dog ran to house with bone in his mouth".split()),
    }
    make = lambda lang, n: (" " if lang == "en" else "").join(word[lang]() for _ in range(n))
    model = langid.Model(["en", "ja", "zh"], [make(x, 3000) for x in ("en", "ja", "zh")], 64)
    parser = langid.Parser(model)
    assert [isinstance(t, langid.Edges) for t in parser.tables] == [False, True, True]
    texts = [make(lang, 60) for lang in ("en", "ja", "zh") for _ in range(4)]
    found, _ = parser.phrases(texts)
    for i, text in enumerate(texts):
        assert found[:, i].tolist() == [_brute(_plain(text), _plain(known), 64) for known in model.texts]
    assert parser.predict(texts)[0] == ["en"] * 4 + ["ja"] * 4 + ["zh"] * 4


def test_columns_of_any_name_stay(spark):
    docs = spark.createDataFrame([(1, "the cat", "x", 2.0)], "doc_id bigint, text string, lang_pred string, score double")
    model = langid.Model(["en"], ["the cat sat"])
    whole = langid.identify(docs, model, whole=True).first()
    assert (whole.row.lang_pred, whole.row.score, whole.lang_pred, whole.score) == ("x", 2.0, "en", 1.0)
    given = langid.identify(docs, model)
    assert given.columns == ["doc_id", "text", "lang_pred", "score", "phrase_rate"] and given.first().lang_pred == "en"


def test_languages(spark):
    english = "the cat sat on the mat and the dog ran to the house with a bone in his mouth "
    german = "der hund lief schnell über die straße und die katze schlief auf dem warmen ofen "
    rows = [(k, t, lang) for k in range(20) for t, lang in ((english, "en"), (german, "de"))]
    odd = [(90, None, "en"), (None, "", None), (91, "12 !!", "de"), (92, "the dog sat on the bone", None), (92, "die katze lief über den hund " * 3000, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string").withColumn("score", F.lit("clash"))
    model = langid.train(docs, F.col("doc_id") < 10)
    got = langid.identify(docs, model, keep=["doc_id", "text"]).collect()
    named = {(r.doc_id, (r.text or "")[:3]): (r.lang_pred, r.score) for r in got}
    assert len(got) == 45
    assert named[90, ""] == named[None, ""] == named[91, "12 "] == ("und", 0.0)
    assert named[92, "the"][0] == "en" and named[92, "die"][0] == "de"
    assert all(0 <= r.score <= 1 for r in got)
    nobody = langid.train(docs, F.lit(False))
    assert {r.lang_pred for r in langid.identify(docs.select("doc_id", "text"), nobody).collect()} == {"und"}
    assert langid.identify(docs.select("doc_id", "text").limit(0), model).count() == 0
