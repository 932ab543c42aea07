from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F
from test_neardup import brute
from test_text_scans import _contamination

from trailmill.llm import langid
from trailmill.llm.common import id_remainder

FOLDER = "/root/testdata/sf0.001"


def test_each_stage_follows_its_rule(spark, tmp_path):
    """Every stage on what its predecessor kept, against the rule said in plain Python."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, items = docs.columns, [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "toxicity", "near_duplicates", "decontamination", "packing"]
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        path, stage_docs = f"{tmp_path}/{name}", docs
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "packing":
            break
        assert docs.columns == columns
        kept = {r.doc_id: r for r in docs.collect()}
        assert all(before[k] == r for k, r in kept.items())
        if name == "language":
            model = langid.train(stage_docs, F.coalesce(id_remainder(F.col("doc_id"), 3) != 1, F.lit(False)))
            told = {r.doc_id: r for r in langid.identify(stage_docs, model, keep=["doc_id"]).collect()}
            assert kept.keys() == {k for k, r in told.items() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SCORE}
            assert kept.keys() <= {k for k, r in before.items() if any(map(str.isalpha, r.text or ""))}
            assert all(len(before[k].text or "") < 100 for k in before.keys() - kept.keys())  # too short to tell
        if name == "near_duplicates":
            rows = [(k, r.text) for k, r in before.items()]
            assert kept.keys() == {k for k, root, _, _ in brute(rows) if k == root}
        if name == "decontamination":
            assert kept.keys() == {k for k, r in before.items() if not _contamination(r.text, items)[-1]}
        before = kept
    assert {r.doc_id for r in docs.select("doc_id").collect()} == before.keys()


def test_run_gives_the_packed_pieces(spark):
    assert corpus_pipeline.run(spark, FOLDER).columns[-2:] == ["sequence_id", "offset"]


def test_the_language_stage_decides_by_the_predicted_language(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    known = sorted(r.lang for r in docs.select("lang").distinct().collect() if r.lang)
    wanted, labelled = known[:2], docs.where("n_chars > 400 AND lang IS NOT NULL")
    monkeypatch.setattr(corpus_pipeline, "WANTED", tuple(wanted))
    kept = corpus_pipeline.language(spark, docs, FOLDER)
    there = {r.lang: r["count"] for r in kept.join(labelled.select("doc_id"), "doc_id").groupBy("lang").count().collect()}
    every = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    assert all(there[x] >= 0.95 * every[x] for x in wanted)
    assert all(there.get(x, 0) <= 0.05 * every[x] for x in known[2:])
    monkeypatch.setattr(corpus_pipeline, "LEAST_SCORE", 1.01)
    assert corpus_pipeline.language(spark, docs, FOLDER).count() == 0


NAMES = ("score", "lang_pred", "phrase_rate", "n_words", "n_hit", "contaminated", "features", "prediction", "toxicity", "lexicon_hits", "__key", "row", "digest", "key")


def test_odd_rows_and_columns_of_any_name_pass_every_stage(spark, tmp_path):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [
        (None, None, "en"), (None, "", None), (None, "a lone text without an id " * 3, "en"), (5001, None, None), (5002, "", "en"),
        (5003, "plain words that stand twice " * 4, "en"), (5003, "plain words that stand twice " * 4, "en"), (5004, "river stone house " * 40_000, None),
    ]
    extra = spark.createDataFrame([(k, t, x, "s", len(t or "")) for k, t, x in odd], given.schema)
    docs = given.unionByName(extra).withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in NAMES})
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
        before, path = docs, f"{tmp_path}/{name}"
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == before.columns
            assert docs.exceptAll(before).count() == 0
    rows = docs.where("doc_id IS NULL OR doc_id > 5000").groupBy("doc_id").sum("length").collect()
    # Texts without a letter went; of the repeated row one stayed; the long text is there whole.
    assert {r.doc_id for r in rows} == {None, 5003, 5004} and next(r for r in rows if r.doc_id == 5004)[1] >= 120_000
