"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of two lexicons (words, and beginnings of words) learned from labelled
texts, how near their hits stand to second-person words, and rates of capitals, punctuation and
obfuscated spellings.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from .common import LOWER, UPPER, Carried, cached, lean, only, slices, stored, text_of

# Parameters of the model. Lexicons and trees are fitted on a sample of about SAMPLE labelled rows, chosen by a
# hash of their key; everything else covers all rows.
SAMPLE = 40_000
LEXICON = 4_000  # terms kept, the most certain ones
LEAST_TEXTS = 4  # toxic texts that hold a term
LEAST_Z = 3.0  # standard errors by which a term's log odds exceed zero
LEAST_LIFT = 8.0  # times as frequent in toxic texts
STARTS = (3, 4, 5)  # lengths of word beginnings
NEAR = 4  # words to a second-person word
TREES, DEPTH = 20, 4

# Second-person words, and characters that stand for letters in disguised spellings.
SECOND_PERSON = frozenset(
    "you your yours yourself ya du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split()
)
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "€": "e"})

FEATURES = (
    "word_density", "word_hits", "start_density", "start_hits", "strongest", "near_second", "second_rate",
    "capital_rate", "shouted_rate", "exclaim_rate", "punctuation_rate", "disguised_rate", "repeated_rate", "log_words",
)

_EDGE = re.compile(r"^[^\w@$*]+|[^\w@$*]+$")
_INNER = re.compile(r"[^\W\d_][^\w\s'’-]+[^\W\d_]|[^\W\d_]\d+[^\W\d_]")
_RUN = re.compile(r"(.)\1\1")


@dataclass(frozen=True)
class Lexicon:
    """Weights (log odds) of terms; LEXICON entries at most."""

    words: dict[str, float]
    starts: dict[str, float]


@dataclass
class Model:
    """``trees`` is None if the labels had one value only or none; ``constant`` is then every score."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None
    constant: float = 0.0


def clean_word(token: str) -> tuple[str, bool]:
    """The token as a plain lower-case word, and whether it was written in disguise."""
    bare = _EDGE.sub("", token)
    if not bare or bare.isalpha():
        return bare.lower(), False
    disguised = bool(_INNER.search(bare)) or "*" in bare.strip("*")
    plain = bare.lower()
    return ("".join(c for c in plain.translate(DISGUISE) if c.isalpha()) if disguised else plain), disguised


class Marks:
    """Marks of tokens for one lexicon, each token's computed once; ``kept`` bounds what is remembered."""

    def __init__(self, lexicon: Lexicon, kept: int = 100_000):
        self.lexicon, self.kept = lexicon, kept
        self.places: dict[str, int] = {}
        self.rows = np.zeros((0, 9), np.float32)

    def of(self, tokens: list[str]) -> np.ndarray:
        """A row of :func:`_term_marks` for each of the distinct tokens."""
        known = self.places
        places = list(map(known.get, tokens))
        missing = [i for i, x in enumerate(places) if x is None]
        if not missing:
            return self.rows[places].astype(np.float64)
        new = _term_marks(self.lexicon, [tokens[i] for i in missing])
        out = np.empty((len(tokens), 9))
        out[missing] = new
        there = [i for i, x in enumerate(places) if x is not None]
        out[there] = self.rows[[places[i] for i in there]]
        short = [(k, i) for k, i in enumerate(missing) if len(tokens[i]) <= 40]
        if len(known) + len(short) > self.kept:
            known.clear()
            self.rows = self.rows[:0]
        base = len(self.rows)
        self.rows = np.concatenate([self.rows, new[[k for k, _ in short]].astype(np.float32)])
        known.update((tokens[i], base + n) for n, (_, i) in enumerate(short))
        return out


def _term_marks(lexicon: Lexicon, tokens: list[str]) -> np.ndarray:
    """For each distinct token: word weight, start weight, second person, capitals, shouted, exclaiming,
    punctuation, disguised, repeated. Weights are rounded to single precision, in which they are remembered."""
    out = np.zeros((len(tokens), 9))
    words, starts = lexicon.words, lexicon.starts
    for i, token in enumerate(tokens):
        word, disguised = (token, False) if token.isalpha() and token.islower() else clean_word(token)
        row = out[i]
        if word:
            row[0] = words.get(word, 0.0)
            row[1] = max(starts.get(word[:n], 0.0) if len(word) > n else 0.0 for n in STARTS)
            row[2] = word in SECOND_PERSON
            if _RUN.search(word):
                row[8] = 1
                if not row[0]:
                    row[0] = words.get(_RUN.sub(r"\1", word), 0.0)
        if word is not token:
            row[3] = sum(map(str.isupper, token))
            row[4] = len(token) > 2 and token.isupper()
            row[5] = token.count("!") + token.count("?")
            row[6] = sum(not c.isalnum() for c in token)
            row[7] = disguised
    return out.astype(np.float32).astype(np.float64)


def feature_matrix(lexicon: Lexicon, texts: pa.Array, marked: Marks | None = None) -> np.ndarray:
    """One row of FEATURES for each text; a null or empty text has zeros. ``marked`` remembers tokens of earlier texts."""
    spaced = pc.replace_substring_regex(pc.fill_null(texts, ""), r"\s", " ")
    lists = pc.split_pattern(spaced, " ")
    counts = np.asarray(pc.list_value_length(lists), np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    coded = lists.flatten().dictionary_encode()
    pieces = coded.dictionary.to_pylist()
    index = np.asarray(coded.indices)
    real = np.array([bool(x) for x in pieces], bool)[index] if pieces else np.zeros(0, bool)
    owner, index = owner[real], index[real]
    marks = (marked or Marks(lexicon)).of(pieces)[index]
    n = len(texts)
    add = lambda x: np.bincount(owner, x, n)
    words = np.maximum(np.bincount(owner, minlength=n), 1)
    letters = np.maximum(np.asarray(pc.utf8_length(spaced), np.float64), 1)
    hit = (marks[:, 0] > 0) | (marks[:, 1] > 0)
    near = np.zeros(len(owner), bool)
    places, second = np.flatnonzero(hit), np.flatnonzero(marks[:, 2] > 0)
    if len(places) and len(second):
        for step in range(2):
            other = second[np.clip(np.searchsorted(second, places) - step, 0, len(second) - 1)]
            near[places] |= (np.abs(other - places) <= NEAR) & (owner[other] == owner[places])
    strongest = np.zeros(n)
    np.maximum.at(strongest, owner, np.maximum(marks[:, 0], marks[:, 1]))
    word_hits, start_hits = add(marks[:, 0] > 0), add(marks[:, 1] > 0)
    columns = [
        word_hits / words, np.log1p(word_hits), start_hits / words, np.log1p(start_hits), strongest,
        add(near) / words, add(marks[:, 2]) / words, add(marks[:, 3]) / letters, add(marks[:, 4]) / words,
        add(marks[:, 5]) / words, add(marks[:, 6]) / letters, add(marks[:, 7]) / words, add(marks[:, 8]) / words,
        np.log1p(np.bincount(owner, minlength=n)),
    ]
    return np.column_stack(columns)


_MARKS: dict[int, Marks] = {}
cached("toxicity", _MARKS.clear)


def _marks(mark: int, lexicon: Lexicon) -> Marks:
    """One memory for each worker process; other operators' are emptied."""
    only("toxicity")
    if mark not in _MARKS:
        _MARKS.clear()
        _MARKS[mark] = Marks(lexicon)
    return _MARKS[mark]


def with_features(docs: DataFrame, lexicon: Lexicon, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row``, the columns ``keep`` as a struct, with ``features`` (array of doubles). No shuffle."""
    carried = Carried(docs, text, keep)
    place, mark = carried.place, hash((tuple(lexicon.words.items()), tuple(lexicon.starts.items())))
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)  # LEXICON entries at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = _marks(mark, sent.value)
        for batch in batches:
            for part in slices(batch, text_of(batch, place), 2_000_000):
                matrix = feature_matrix(sent.value, text_of(part, place), marked)
                offsets = np.arange(len(matrix) + 1, dtype=np.int32) * len(FEATURES)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.ListArray.from_arrays(offsets, matrix.reshape(-1))], names=["row", "features"]
                )

    return carried.frame.mapInArrow(lean(run), carried.shape("features array<double>"))


def _starts(size: int) -> Column:
    """The distinct beginnings of the longer words, marked as such."""
    longer = F.filter("words", lambda w: F.char_length(w) > size)
    return F.array_distinct(F.transform(longer, lambda w: F.concat(F.lit("^"), F.substring(w, 1, size))))


def learn_lexicon(texts: DataFrame) -> Lexicon:
    """Terms of ``texts`` (text, toxic 0/1) by their log odds, from the numbers of texts that hold them."""
    totals = texts.groupBy("toxic").count().collect()  # two rows
    bad, good = (sum(r["count"] for r in totals if r["toxic"] == x) for x in (1, 0))
    if not bad:
        return Lexicon({}, {})
    lowered = F.lower(F.translate("text", UPPER, LOWER))
    words = F.array_distinct(F.regexp_extract_all(lowered, F.lit(r"\p{L}{2,40}"), F.lit(0)))
    starts = [_starts(n) for n in STARTS]
    terms = texts.select("toxic", words.alias("words")).select("toxic", F.explode(F.concat("words", *starts)).alias("term"))
    counts = terms.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (bad - F.col("a") + 0.5)) - F.log(b / (good - F.col("b") + 0.5))
    scored = counts.filter(F.col("a") >= LEAST_TEXTS).select("term", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
    kept = scored.filter((F.col("z") >= LEAST_Z) & (F.col("odds") >= math.log(LEAST_LIFT)))
    found = {r["term"]: r["odds"] for r in kept.orderBy(F.desc("z"), "term").limit(LEXICON).collect()}
    return Lexicon(
        {t: w for t, w in found.items() if t[0] != "^"}, {t[1:]: w for t, w in found.items() if t[0] == "^"}
    )


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """A model from the rows of ``labels`` (key, toxic) given, joined to their texts.

    Rows with a null key, text or label take no part; a label other than 0 or 1 neither.
    """
    usable = labels.select(F.col(key).alias("key"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("key").isNotNull() & F.col("toxic").isin(0, 1)
    )
    count = usable.count()
    if not count:
        return Model(Lexicon({}, {}))
    share = min(1.0, SAMPLE / count)
    chosen = usable.filter(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(share * 1_000_000))
    # About SAMPLE rows of two numbers, whatever the size of the tables: small enough to send.
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).filter("text IS NOT NULL")
    sample = stored(rows.join(F.broadcast(chosen), "key"), "toxicity-sample")
    # A quarter of the sample is the calibration's own: neither the lexicon nor the trees see it.
    sample = sample.withColumn("fold", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(4)))
    lexicon = learn_lexicon(sample.filter("fold <> 3"))
    table = with_features(sample, lexicon, keep=["toxic", "fold"]).select("row.toxic", "row.fold", "features")
    table = stored(table, "toxicity-features")
    values = {(r["calibrates"], r["toxic"]) for r in table.select((F.col("fold") == 3).alias("calibrates"), "toxic").distinct().collect()}
    if not {(False, 0), (False, 1)} <= values:
        return Model(lexicon, constant=float(max((x for _, x in values), default=0)))
    vectors = table.select(F.col("toxic").cast("double").alias("label"), "fold", array_to_vector("features").alias("features"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=42, minInstancesPerNode=10, maxBins=64).fit(vectors.filter("fold <> 3"))
    if not {(True, 0), (True, 1)} <= values:
        return Model(lexicon, trees)
    raw = trees.transform(vectors.filter("fold = 3")).select("label", vector_to_array("probability")[1].alias("raw"))
    return Model(lexicon, trees, IsotonicRegression(featuresCol="raw", labelCol="label").fit(_as_vector(raw)))


def _as_vector(frame: DataFrame) -> DataFrame:
    return frame.withColumn("raw", array_to_vector(F.array("raw")))


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, whole: bool = False) -> DataFrame:
    """The columns ``keep`` of every row with toxicity (0 to 1) and lexicon_hits.

    Every row gets a score, empty and null texts too; rows are independent of each other, so nulls elsewhere,
    repeated rows and other columns change nothing. No shuffle. A kept column named like a result gives way to it; with
    ``whole`` the kept columns stay apart, in the struct ``row``.
    """
    table = with_features(docs, model.lexicon, text, keep)
    hits = F.round(F.expm1(F.col("features")[1]) + F.expm1(F.col("features")[3])).cast("long").alias("lexicon_hits")
    if model.trees is None:
        found = table.select("row", F.lit(model.constant).alias("toxicity"), hits)
    else:
        raw = model.trees.transform(table.select("row", hits, array_to_vector("features").alias("features")))
        raw = raw.withColumn("raw", vector_to_array("probability")[1])
        toxicity = F.col("raw")
        if model.calibration is not None:
            raw = model.calibration.setPredictionCol("calibrated").transform(_as_vector(raw))
            toxicity = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated")))
        found = raw.select("row", toxicity.alias("toxicity"), "lexicon_hits")
    return found if whole else Carried(docs, text, keep).unpacked(found, "toxicity", "lexicon_hits")
