from __future__ import annotations

import bisect
import math
import random

import pyarrow as pa
from pyspark.sql import functions as F

from trailmill.llm import toxicity


def test_features():
    lexicon = toxicity.Lexicon({"idiot": 3.0}, {"lowei": 2.0})
    texts = ["you IDIOT!! calm", "an 1d10t and id!ot", "loweiß da", None, "", "plain words only", "idiot" + " far" * 9 + " you", "iiidiot"]
    rows = toxicity.feature_matrix(lexicon, pa.array(texts, pa.string()))
    named = [dict(zip(toxicity.FEATURES, r)) for r in rows]
    assert round(named[0]["word_density"], 4) == round(1 / 3, 4) and named[0]["near_second"] > 0 and named[0]["capital_rate"] > 0
    assert named[1]["disguised_rate"] == 0.5 and named[1]["word_density"] == 0.5
    assert named[2]["start_density"] == 0.5 and named[2]["strongest"] == 2.0
    assert not any(rows[3]) and not any(rows[4])
    assert named[5]["strongest"] == 0 and named[6]["near_second"] == 0 and named[7]["repeated_rate"] == 1.0


def test_scores(spark, docs_of):
    rng = random.Random(1)
    fair = lambda n: [rng.choice(["river", "stone", "house", "green", "walk", "paper", "you"]) for _ in range(n)]
    rows, labels = [], []
    for k in range(600):
        words, bad = fair(40), k % 6 == 0
        if bad:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["grumbold", "snarkle", "blighted"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    odd = [(9000, None), (9001, ""), (None, "you snarkle grumbold blighted " * 4), (9002, "river " * 20_000), (9002, "river " * 20_000)]
    table = spark.createDataFrame([*labels, (1, None), (None, 1), (5, 7)], "doc_id bigint, toxic int")
    docs = docs_of(rows + odd)
    model = toxicity.train(docs, table)
    got = toxicity.score(docs, model, keep=["doc_id"]).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.toxicity <= 1 for r in got)
    score = {r.doc_id: r.toxicity for r in got}
    assert all((score[k] >= 0.5) == bool(bad) for k, bad in labels)
    assert score[None] >= 0.5 and max(score[9000], score[9001], score[9002]) < 0.5
    for part in (table.limit(0), table.filter("toxic = 0")):
        assert {r.toxicity for r in toxicity.score(docs, toxicity.train(docs, part), keep=["doc_id"]).collect()} == {0.0}
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.train(empty, table), keep=["doc_id"]).count() == 0
    names = ("features", "prediction", "probability", "rawPrediction", "toxicity", "raw", "calibrated", "row")
    clash = docs.withColumns({n: F.lit(n) for n in names})
    whole = toxicity.score(clash, model, whole=True)
    assert whole.select("row.*").columns == clash.columns and whole.filter("row.prediction = 'prediction' AND toxicity >= 0").count() == len(got)
    assert toxicity.score(clash, model).filter("features = 'features'").select("toxicity").dtypes == [("toxicity", "double")]


def _tree_value(node, row):
    while node.subtreeDepth():
        split = node.split()
        node = node.leftChild() if row[split.featureIndex()] <= split.threshold() else node.rightChild()
    return node.prediction()


def test_scores_are_those_of_the_trees_and_the_calibration(spark):
    """Scores again from the model's own parameters, in plain Python: the sum of the trees, the logistic
    function, and the line between the calibration's neighbours."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet").where("doc_id % 5 <> 0"))
    some = docs.where("doc_id % 4 = 0")
    got = {r.doc_id: r.toxicity for r in toxicity.score(some, model, keep=["doc_id"]).collect()}
    rows = some.collect()
    matrix = toxicity.feature_matrix(model.lexicon, pa.array([r.text for r in rows], pa.string()))
    trees = [(t._java_obj.rootNode(), w) for t, w in zip(model.trees.trees, model.trees.treeWeights)]
    at, level = (list(x) for x in (model.calibration.boundaries, model.calibration.predictions))
    for r, features in zip(rows, matrix.tolist()):
        total = sum(w * _tree_value(node, features) for node, w in trees)
        raw = 1 / (1 + math.exp(-2 * total))
        k = bisect.bisect_left(at, raw)
        if k == len(at):
            wanted = level[-1]
        elif at[k] == raw or k == 0:
            wanted = level[k]
        else:
            wanted = level[k - 1] + (level[k] - level[k - 1]) * (raw - at[k - 1]) / (at[k] - at[k - 1])
        assert abs(got[r.doc_id] - min(1.0, max(0.0, wanted))) < 1e-9


def test_the_calibration_has_rows_of_its_own(spark, docs_of, monkeypatch):
    """A word that only the calibration's rows have is not in the lexicon."""
    seen = []
    real = toxicity.learn_lexicon
    monkeypatch.setattr(toxicity, "learn_lexicon", lambda texts: seen.append({r.key for r in texts.collect()}) or real(texts))
    rows = [(k, "snarkle you" if k % 3 == 0 else "river stone") for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(400)], "doc_id bigint, toxic int")
    toxicity.train(docs_of(rows), labels)
    folds = spark.range(400).select("id", F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.lit(4)).alias("fold")).collect()
    assert seen == [{r.id for r in folds if r.fold != 3}]


def test_remembered_tokens_have_the_same_marks():
    lexicon = toxicity.Lexicon({"idiot": 3.1}, {"lowei": 2.2})
    marks = toxicity.Marks(lexicon, kept=6)
    for tokens in (["you", "IDIOT!!", "x" * 50], ["loweiss", "you", "IDIOT!!"], ["a", "b", "c", "d", "you"], ["you", "d"]):
        assert (marks.of(tokens) == toxicity._term_marks(lexicon, tokens)).all()
    assert len(marks.places) <= 6 and marks.of([]).shape == (0, 9)
