"""Token counts by whole tokens: pre-tokens that are one token by themselves are counted, not merged.

``whole_tokens`` proves once, before any document is read, which vocabulary strings encode alone as
exactly their own id. In a text, a pre-token found in that set counts as one; only the others go
through the merges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import tokens
from .common import cached, only, slices


def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings whose text, alone, encodes to their one id. Bounded by the vocabulary."""
    tokenizer = tokens.load(path)
    texts = {}
    for written, number in tokenizer.get_vocab(with_added_tokens=False).items():
        text = _plain_text(written.removesuffix("</w>"))
        if text and tokens._PLAIN.fullmatch(text):
            texts[number] = text
    found = tokenizer.encode_batch_fast(list(texts.values()), add_special_tokens=False)
    return frozenset(text for (number, text), e in zip(texts.items(), found) if e.ids == [number])


def _plain_text(written: str) -> str | None:
    """The text of a byte-level vocabulary string; None if it isn't whole UTF-8."""
    try:
        return bytes(_BYTE_OF[c] for c in written).decode()
    except (KeyError, UnicodeDecodeError):
        return None


_BYTE_OF = {tokens._WRITTEN.get(b, chr(b)): b for b in range(256)}


class Counter:
    """Counts of distinct pieces; ``kept`` bounds what is remembered. ``merged`` counts merges made."""

    def __init__(self, path: str, whole: frozenset[str], kept: int = 800_000):
        self.encoder, self.whole = tokens.PieceEncoder(path), whole
        self.kept, self.known, self.merged = kept, {}, 0

    def pieces(self, pieces: list[str]) -> np.ndarray:
        known, whole = self.known, self.whole
        if self.encoder.drops_space:
            pieces = [x.lower() if tokens._PLAIN.fullmatch(x) else x for x in pieces]
        rest = {x for x in pieces if x not in whole and x not in known}
        plain = [x for x in rest if tokens._PLAIN.fullmatch(x)]
        odd = list(rest.difference(plain))
        counts = {}
        for asked, encode in ((plain, self.encoder.merged), (odd, self.encoder.library)):
            counts.update((x, len(ids) // 4) for x, ids in zip(asked, encode(asked)))
        self.merged += len(rest)
        found = (1 if x in whole else known[x] if x in known else counts[x] for x in pieces)
        out = np.fromiter(found, np.int64, len(pieces))
        if len(known) + len(counts) > self.kept:
            known.clear()
        known.update((k, v) for k, v in counts.items() if len(k) <= tokens._LONGEST_KEPT)
        return out

    def count(self, texts: pa.Array) -> np.ndarray:
        bounds, flat = self.encoder.split(pc.fill_null(texts.cast(pa.string()), ""))
        coded = flat.dictionary_encode()
        each = self.pieces(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
        return np.diff(np.concatenate([[0], np.cumsum(each)])[bounds])


_COUNTERS: dict[str, Counter] = {}
cached("tokencount", _COUNTERS.clear)


def _counter(path: str, whole: frozenset[str]) -> Counter:
    """One counter for each worker process and vocabulary file; other operators' memories are emptied."""
    only("tokencount")
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path, whole)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_bytes (UTF-8), n_tokens and over_limit for every row; nothing is shuffled.

    A null or empty text has 0 bytes and 0 tokens; null and repeated keys keep their rows; other
    columns are ignored. Special strings in a text are handled as the library does by default.
    """
    spark = docs.sparkSession
    proven = spark.sparkContext.broadcast(whole_tokens(path))  # at most the vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, proven.value)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text")
                n = counter.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()),
                        pa.array(n),
                        pa.array(n > limit),
                    ],
                    names=[key, "n_bytes", "n_tokens", "over_limit"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text")).mapInArrow(
        count, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
