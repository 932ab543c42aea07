"""Token ids of many texts with the tokenizers library, each distinct piece of text encoded once.

White space bounds the pre-tokens of both supported kinds of vocabulary, so a text's ids are those of
its pieces between spaces, one after the other. Arrow splits the texts and finds the distinct pieces;
the library encodes the ones not seen before. Texts where a cut at a space could matter (runs of white
space and rarer white-space characters) are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import cached, only

# Letters whose class, case and normal form are the same for every library: one pre-token whatever stands
# around them, and so is plain punctuation behind them, before white space or the end.
_PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+|[.,!?;:]+")
_BEHIND = "([A-Za-z\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{ff}])([.,!?;:]+)(%s|\\z)"
# White space for which a cut at a space would not be safe in a vocabulary that keeps white space.
_ODD = (
    "[\\x00\\t\\x0b\\x0c\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}"
    "\\x{202f}\\x{205f}\\x{3000}]|[ \\n][ \\n]|\\A[ \\n]|[ \\n]\\z"
)
_LONGEST_KEPT = 64
KEPT = 1_000_000  # pieces, about 180 bytes each
# How byte-level vocabularies write bytes: printable ones as themselves, the others from U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_WRITTEN = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _punctuation_apart(texts: pa.Array, mark: str) -> pa.Array:
    """``mark`` between letters and the plain punctuation behind them; that is a bound of pre-tokens anyway."""
    end = "\\x00" if mark == "\0" else mark
    return pc.replace_substring_regex(texts, _BEHIND % end, f"\\1{mark}\\2\\3")


class PieceEncoder:
    """Encodes Arrow arrays of texts. ``kept`` bounds what is remembered: strings of 64 characters at most."""

    def __init__(self, path: str, kept: int = KEPT):
        self.tokenizer = load(path)
        self.drops_space = self.tokenizer.normalizer is not None
        self.kept, self.pieces = kept, {}

    def library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, "<u4").tobytes() for x in found]

    def merged(self, pre_tokens: list[str]) -> list[bytes]:
        """The ids of plain pre-tokens (normalised already): the library's model alone merges them."""
        model, out = self.tokenizer.model, []
        for text in pre_tokens:
            if not text.isascii():
                text = text.encode().decode("latin-1").translate(_WRITTEN)
            elif text[0] == " ":
                text = _WRITTEN[0x20] + text[1:]
            found = model.tokenize(text)
            out.append(found[0].id.to_bytes(4, "little") if len(found) == 1 else array("I", [t.id for t in found]).tobytes())
        return out

    def split(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Offsets of each text's pieces, and the pieces."""
        if self.drops_space:
            lists = pc.split_pattern(_punctuation_apart(pc.replace_substring(texts, "\n", " "), " "), " ")
        else:
            whole = pc.match_substring_regex(texts, _ODD)
            cut = pc.split_pattern(_punctuation_apart(pc.replace_substring(texts, " ", "\0 "), "\0"), "\0")
            if pc.any(whole).as_py():
                alone = pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32), texts)
                lists = pc.if_else(whole, alone, cut)
            else:
                lists = cut
        counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
        return np.concatenate([[0], np.cumsum(counts)]), lists.flatten()

    def fresh(self, new: list[str]) -> dict[str, bytes]:
        """The ids of pieces not seen before."""
        plain, odd = [], []
        for x in new:
            (plain if _PLAIN.fullmatch(x) else odd).append(x)
        lowered = [x.lower() for x in plain] if self.drops_space else plain
        found = dict(zip(plain, self.merged(lowered)))
        found.update(zip(odd, self.library(odd)))
        return found

    def resolve(self, pieces: list[str]) -> list[bytes]:
        """The ids of each distinct piece, as little-endian bytes."""
        known = self.pieces
        found = list(map(known.get, pieces))
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            fresh = self.fresh([pieces[i] for i in missing])
            for i in missing:
                found[i] = fresh[pieces[i]]
            if len(known) + len(fresh) > self.kept:
                known.clear()
            known.update((k, v) for k, v in fresh.items() if len(k) <= _LONGEST_KEPT)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): text i has ids[offsets[i]:offsets[i + 1]]. A missing text counts as empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        bounds, flat = self.split(texts)
        coded = flat.dictionary_encode()
        found = pa.array(self.resolve(coded.dictionary.to_pylist()), pa.large_binary())
        # The pieces' ids, taken in the texts' order, lie end to end.
        laid = found.take(coded.indices)
        ends = np.frombuffer(laid.buffers()[1], np.int64)[: len(laid) + 1] // 4
        data = laid.buffers()[2]
        return ends[bounds], np.frombuffer(data, "<u4")[: ends[-1]] if data is not None else np.zeros(0, "<u4")


_LOADED: dict[str, PieceEncoder] = {}
cached("tokens", _LOADED.clear)


def encoder(path: str, kept: int = KEPT) -> PieceEncoder:
    """One encoder for each worker process and vocabulary file, remembering ``kept`` pieces; other operators' memories are emptied."""
    only("tokens")
    if path not in _LOADED or _LOADED[path].kept != kept:
        _LOADED[path] = PieceEncoder(path, kept)
    return _LOADED[path]
