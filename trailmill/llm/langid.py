"""Language identification by cross-parsing entropy.

For each language, a suffix automaton of labelled text. A document is parsed from left to right into
the longest phrases that occur in the language's text; the language whose text parses it into the
fewest phrases, normalised by the logarithm of the text's size, wins. Automata are tables of one row
per state, so that many texts are walked side by side with array operations.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import Carried, cached, lean, only, slices, text_of

# Parameters of the model; the sample they bound is the only part of the data that is sampled.
TRAINING_CHARS = 48_000  # of each language
TRAINING_TEXTS = 200  # of each language, at most
CHUNK = 1_000  # characters taken from the middle of a longer training text
SEGMENT = 1_024  # a phrase ends at the latest where a stretch of so many characters ends
UNKNOWN = "und"
DENSE = 126  # letters of a language whose transitions are a row for each state
_SPACE, _OTHER, _FIRST = 0, 1, 2


class SuffixAutomaton:
    """The automaton of all substrings of a text of small integers."""

    def __init__(self, text: list[int]):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            new = len(self.next)
            self.next.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = link[p]
                    link[q] = link[new] = clone
            last = new

    def table(self, symbols: int) -> np.ndarray:
        """Row-major transitions: twice the next state's row start; odd where no phrase goes on and a new
        one begins with the symbol (at the start again, if even that is not in the text)."""
        out = np.empty((len(self.next), symbols), np.int32)
        begin = np.zeros(symbols, np.int32)
        for c, state in self.next[0].items():
            begin[c] = 2 * state * symbols
        out[:] = begin + 1
        for state, edges in enumerate(self.next):
            for c, target in edges.items():
                out[state, c] = 2 * target * symbols
        out[0] = begin + 1  # a phrase begins
        return out.reshape(-1)

    def edges(self, symbols: int) -> Edges:
        """The same for any number of symbols: only transitions that exist."""
        begin = np.zeros(symbols, np.int64)
        for c, state in self.next[0].items():
            begin[c] = 2 * state * symbols
        pairs = sorted((state * symbols + c, 2 * target * symbols) for state, edges in enumerate(self.next) if state for c, target in edges.items())
        keys, targets = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        return Edges(keys, targets, begin + 1, symbols)


@dataclass
class Edges:
    """A table of transitions that are looked up by their place, as :meth:`SuffixAutomaton.table` numbers them."""

    keys: np.ndarray
    targets: np.ndarray
    begin: np.ndarray
    symbols: int

    def __getitem__(self, place: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return self.begin[place % self.symbols]
        at = np.minimum(np.searchsorted(self.keys, place), len(self.keys) - 1)
        return np.where(self.keys[at] == place, self.targets[at], self.begin[place % self.symbols])


_LETTERS = None


def _codes_of_text(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _LETTERS


def normalised(points: np.ndarray) -> np.ndarray:
    """Code points of letters, each run of anything else as one space."""
    points = np.where(_letters()[points], points, 32)
    space = points == 32
    return points[~(space & np.concatenate([[False], space[:-1]]))]


@dataclass
class Model:
    """Training text of each language, as it is sent to the workers: a few ten thousand characters each."""

    languages: list[str]
    texts: list[str]
    segment: int = SEGMENT


class Parser:
    """The tables of a model; about 10 MB for each language. Every letter of a language's text is a symbol of its own.

    A language of more than DENSE letters has its transitions in sorted arrays instead of a row for each state.
    """

    def __init__(self, model: Model):
        self.model = model
        self.codes, self.tables, weights = [], [], []
        space = ~_letters()
        for text in model.texts:
            points = normalised(_codes_of_text(text.lower()))
            letters = np.unique(points[points != 32])
            code = np.full(sys.maxunicode + 1, _OTHER, np.uint16 if len(letters) > 250 else np.uint8)
            code[space] = _SPACE
            code[letters] = _FIRST + np.arange(len(letters))
            automaton = SuffixAutomaton(code[points].tolist())
            symbols = len(letters) + _FIRST
            self.codes.append(code)
            self.tables.append(automaton.table(symbols) if len(letters) <= DENSE else automaton.edges(symbols))
            weights.append(math.log2(max(len(points), 2)))
        self.weights = np.array(weights)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(languages x texts) numbers of phrases, and the letters of each text."""
        points = _codes_of_text("\n".join(x.replace("\n", " ") for x in texts))
        ends = np.flatnonzero(points == 10)
        bounds = np.concatenate([[-1], ends, [len(points)]]) + 1
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))[: len(points)]
        space = ~_letters()[points]
        counts = np.bincount(owner[~space], minlength=len(texts))
        inside = points != 10
        points, space, owner = points[inside], space[inside], owner[inside]
        again = space[1:] & space[:-1] & (owner[1:] == owner[:-1])
        keep = np.concatenate([[True], ~again])[: len(points)]
        points, owner = points[keep], owner[keep]
        sizes = np.bincount(owner, minlength=len(texts))
        starts = np.cumsum(sizes) - sizes
        each = -(-sizes // self.model.segment)
        lane_owner = np.repeat(np.arange(len(texts)), each)
        nth = np.arange(len(lane_owner)) - np.repeat(np.cumsum(each) - each, each)
        lane_start = starts[lane_owner] + nth * self.model.segment
        lane_size = np.minimum(sizes[lane_owner] - nth * self.model.segment, self.model.segment)
        order = np.argsort(-lane_size, kind="stable")
        lane_owner, lane_start, lane_size = lane_owner[order], lane_start[order], lane_size[order]
        live = len(lane_size) - np.searchsorted(lane_size[::-1], np.arange(1, (lane_size[0] if len(order) else 0) + 1))
        found = np.zeros((len(self.tables), len(texts)), np.int64)
        for k, table in enumerate(self.tables):
            code = self.codes[k][points]
            state = np.zeros(len(lane_size), np.int32 if isinstance(table, np.ndarray) else np.int64)
            number = np.zeros(len(lane_size), np.int32)
            for t, n in enumerate(live):  # lanes are sorted by size: the first n still have a character
                step = table[state[:n] + code[lane_start[:n] + t]]
                number[:n] += step & 1
                state[:n] = step >> 1
            found[k] = np.bincount(lane_owner, number, len(texts))
        return found, counts

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and phrases per letter of the winner. Ties go to the first language by name."""
        found, letters = self.phrases(texts)
        known = letters > 0
        if not len(self.tables):
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        cost = found * self.weights[:, None]
        best = cost.argmin(axis=0)
        rows = np.arange(len(texts))
        first = cost[best, rows]
        others = cost.copy()
        others[best, rows] = np.inf
        second = others.min(axis=0) if len(self.tables) > 1 else np.full(len(texts), np.inf)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(np.isinf(second), 1.0, second / (first + second))
            rate = np.where(known, found[best, rows] / np.maximum(letters, 1), 0.0)
        languages = [self.model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return languages, np.where(known, score, 0.0), rate


def train(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from the rows where ``learn`` holds and the language is given.

    Per language at most TRAINING_TEXTS texts, the first in the order of a hash of key and text, up to
    TRAINING_CHARS characters; of a longer text its middle CHUNK. That bounded sample is collected.
    """
    size = F.char_length(text)
    middle = F.substring(text, F.greatest(F.lit(1), F.floor((size - CHUNK) / 2) + 1).cast("int"), F.lit(CHUNK))
    rows = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.xxhash64(F.col(key), F.col(text)).alias("order"), middle.alias("text")
    ).filter(F.rlike("text", F.lit(r"\p{L}{2}")))
    ranked = rows.withColumn("nth", F.row_number().over(W.partitionBy("lang").orderBy("order", "text")))
    sample = ranked.filter(F.col("nth") <= TRAINING_TEXTS).orderBy("lang", "order", "text").collect()
    texts: dict[str, list[str]] = {}
    for row in sample:
        texts.setdefault(row["lang"], []).append(row["text"])
    languages = sorted(texts)
    return Model(languages, [" ".join(dict.fromkeys(texts[x]))[:TRAINING_CHARS] for x in languages])


_PARSERS: dict[tuple, Parser] = {}
cached("langid", _PARSERS.clear)


def _parser(mark: tuple, model: Model) -> Parser:
    """One parser for each worker process; other operators' memories are emptied."""
    only("langid")
    if mark not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[mark] = Parser(model)
    return _PARSERS[mark]


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, whole: bool = False) -> DataFrame:
    """The columns ``keep`` of every row with lang_pred, score (0 to 1) and phrase_rate.

    score is the share that the second-best language has of both costs: 0.5 for a tie, near 1 for
    certainty. A text that is null or has no letters is `und` with score 0. Rows are independent:
    nulls elsewhere, repeated rows and other columns change nothing. No shuffle. A kept column named like a result gives
    way to it; with ``whole`` the kept columns stay apart, in the struct ``row``.
    """
    carried = Carried(docs, text, keep)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # TRAINING_CHARS for each language
    mark, place = (tuple(model.languages), tuple(map(hash, model.texts)), model.segment), carried.place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(mark, sent.value)
        for batch in batches:
            for part in slices(batch, text_of(batch, place), 2_000_000):
                texts = pc.utf8_lower(pc.fill_null(text_of(part, place), "")).to_pylist()
                languages, score, rate = parser.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(languages, pa.string()), pa.array(score), pa.array(rate)],
                    names=["row", "lang_pred", "score", "phrase_rate"],
                )

    found = carried.frame.mapInArrow(lean(run), carried.shape("lang_pred string, score double, phrase_rate double"))
    return found if whole else carried.unpacked(found, "lang_pred", "score", "phrase_rate")
