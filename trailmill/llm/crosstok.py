"""Alignment of two tokenizers over a corpus.

Each text is encoded by a byte-level vocabulary (A, of a space and the text) and by a sentencepiece model (B, of
the text, before which it puts the space itself). Byte offsets where tokens of both end cut them into groups; every A
token of a group is linked with every B token of it. How many documents hold a pair of ids linked is counted over the
corpus, and each document is told how many of its links are the best of their A id.

The work on a slice of texts is columnar: lists of ids are flattened and keep their parents' indices, ends are
cumulative sums within each document, hash joins on (document, end) find the common ends and hash joins on the
group give the links, and a grouped count per slice joins the slices before it, so that tasks hand partial counts to
Spark, which merges them. Links never leave a task: a document keeps its distinct pairs and how often it has each.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from . import tokens
from .common import cached, lean, only, slices, stored

# A table of this many pairs, 13 bytes each, is sent to every worker; a larger one is joined by shuffle.
SENT = 4_000_000
_SLICE = 1_000_000
_LINKS = 4_000_000  # of one hash join
_HELD = 600_000  # pairs that a task counts before it hands them over


# ---- the two vocabularies -------------------------------------------------------------------------
class SpacedEncoder(tokens.PieceEncoder):
    """Encodes a space and the text; the strings of special tokens are ordinary text."""

    def __init__(self, path: str, kept: int = 300_000):
        super().__init__(path, kept)
        self.tokenizer.encode_special_tokens = True
        shown = {chr(b): b for b in tokens._SHOWN} | {text: b for b, text in tokens._WRITTEN.items()}
        entries = [b""] * (1 + max(self.tokenizer.get_vocab().values()))
        for entry, number in self.tokenizer.get_vocab().items():
            if all(c in shown for c in entry):
                entries[number] = bytes(shown[c] for c in entry)
        self.bytes = pa.array(entries, pa.large_binary())

    def split(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        whole = pc.match_substring_regex(texts, tokens._ODD)
        spaced = with_space(texts)
        cut = pc.split_pattern(tokens._punctuation_apart(pc.replace_substring(spaced, " ", "\0 "), "\0"), "\0")
        return _bounds(_alone_where(whole, spaced, cut))


class SentencePieces(tokens.PieceEncoder):
    """A sentencepiece model. Words between single spaces are encoded once each, if no piece of the vocabulary has a
    space behind another character: then no merge crosses the space, and a word's ids don't depend on its neighbours."""

    def __init__(self, path: str, kept: int = 300_000):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        self.kept, self.pieces = kept, {}
        count = self.processor.get_piece_size()
        found = [self.processor.id_to_piece(i) for i in range(count)]
        self.apart = not any("\u2581" in x.lstrip("\u2581") for x in found)
        self.bytes = pa.array(
            [bytes([int(x[3:5], 16)]) if self.processor.is_byte(i) else x.replace("\u2581", " ").encode() for i, x in enumerate(found)],
            pa.large_binary(),
        )

    def split(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        whole = pc.match_substring_regex(texts, "  |\\A | \\z|\u2581") if self.apart else pa.array(np.ones(len(texts), bool))
        return _bounds(_alone_where(whole, texts, pc.split_pattern(texts, " ")))

    def fresh(self, new: list[str]) -> dict[str, bytes]:
        return {x: array("I", ids).tobytes() for x, ids in zip(new, self.processor.encode(new, num_threads=1))}


def with_space(texts: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise("", texts, " ")


def _alone_where(whole: pa.Array, texts: pa.Array, lists: pa.Array) -> pa.Array:
    if not pc.any(whole).as_py():
        return lists
    return pc.if_else(whole, pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32), texts), lists)


def _bounds(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    return np.concatenate([[0], np.cumsum(counts)]), lists.flatten()


_LOADED: dict[tuple[str, str], tuple[SpacedEncoder, SentencePieces]] = {}
cached("crosstok", _LOADED.clear)


def _coders(path_a: str, path_b: str) -> tuple[SpacedEncoder, SentencePieces]:
    """One pair of encoders for each worker process and pair of files."""
    only("crosstok")
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = SpacedEncoder(path_a), SentencePieces(path_b)
    return _LOADED[path_a, path_b]


# ---- one slice of texts -----------------------------------------------------------------------------
def _joined(bounds: np.ndarray, ids: np.ndarray, entries: pa.Array) -> list[bytes]:
    """The bytes of each text's tokens together."""
    pool = entries.take(pa.array(ids))
    ends = np.asarray(pa.Array.from_buffers(pa.int64(), len(pool) + 1, [None, pool.buffers()[1]]))
    data = memoryview(pool.buffers()[2] or b"")
    return [data[ends[a] : ends[b]].tobytes() for a, b in zip(bounds, bounds[1:])]


class _Side:
    """The tokens of the texts of a slice, by one vocabulary."""

    def __init__(self, bounds: np.ndarray, ids: np.ndarray, valid: np.ndarray, entries: pa.Array):
        lists = pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int64))).filter(pa.array(valid))
        self.ids, self.doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
        self.count = np.asarray(pc.list_value_length(lists))
        so_far = pc.cumulative_sum(pc.binary_length(entries).take(self.ids).cast(pa.int64()))
        first = np.cumsum(self.count) - self.count
        before = np.concatenate([[0], np.asarray(so_far)])[first]
        self.end = pc.subtract(so_far, pa.array(before).take(self.doc))

    def ends(self, row: str) -> pa.Table:
        return pa.table({"doc": self.doc, "end": self.end, row: pa.array(np.arange(len(self.ids)))})

    def cut(self, rows: np.ndarray) -> None:
        """Groups end with the tokens ``rows``; groups are numbered over all texts."""
        self.last = np.zeros(len(self.ids), np.int64)
        self.last[rows] = 1
        self.group = np.cumsum(self.last) - self.last


def _links(a: _Side, b: _Side, width: int) -> pa.Table:
    """doc, pair and n: how often each document has each pair of ids linked. A pair is a * width + b."""
    each = np.bincount(b.group, minlength=int(a.group[-1]) + 1)[a.group] if len(a.group) else np.zeros(0, np.int64)
    part = (np.cumsum(each) - each) // _LINKS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    left = pa.table({"group": a.group, "doc": a.doc, "a": a.ids})
    right = pa.table({"group": b.group, "b": b.ids})
    counted = []
    for low, high in zip(cuts, cuts[1:]):
        if high == low:
            continue
        first, last = np.searchsorted(b.group, [a.group[low], a.group[high - 1] + 1])
        met = left.slice(low, high - low).join(right.slice(first, last - first), "group", join_type="inner", use_threads=False)
        pair = pc.add(pc.multiply(met.column("a"), width), met.column("b"))
        one = pa.table({"doc": met.column("doc"), "pair": pair})
        counted.append(one.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]))
    if not counted:
        return pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    if len(counted) == 1:
        return counted[0].rename_columns(["doc", "pair", "n"])
    return _added(counted, ["doc", "pair"], "count_all").rename_columns(["doc", "pair", "n"])


def _added(tables: list[pa.Table], keys: list[str], value: str) -> pa.Table:
    whole = pa.concat_tables(tables)
    return whole.group_by(keys, use_threads=False).aggregate([(value, "sum")]).select([*keys, f"{value}_sum"])


def _written(a: _Side, b: _Side, pool: pa.Array) -> list[memoryview]:
    """The groups of each text, as `a1,a2|b1;a3|b2,b3`."""
    groups = int(a.last.sum())
    in_a, in_b = (np.bincount(x.group, minlength=groups) for x in (a, b))
    upto_a, before_b = np.cumsum(in_a), np.cumsum(in_b) - in_b
    order = np.empty(len(a.ids) + len(b.ids), np.int64)
    order[np.arange(len(a.ids)) + before_b[a.group]] = 3 * np.asarray(a.ids) + a.last
    order[np.arange(len(b.ids)) + upto_a[b.group]] = 3 * np.asarray(b.ids) + 2 * b.last
    text = pool.take(pa.array(order))
    ends = np.asarray(pa.Array.from_buffers(pa.int64(), len(text) + 1, [None, text.buffers()[1]]))
    data = memoryview(text.buffers()[2] or b"")
    bounds = ends[np.concatenate([[0], np.cumsum(a.count + b.count)])]
    return [data[x : y - 1] for x, y in zip(bounds, bounds[1:])]  # without the last separator


def _pool(size: int) -> pa.Array:
    """Every id behind which a token of its group, the other side, or the next group follows."""
    return pa.array([f"{i}{mark}" for i in range(size) for mark in ",|;"], pa.large_string())


# ---- over the corpus --------------------------------------------------------------------------------
def _tokens(docs: DataFrame, path_a: str, path_b: str, key: str, text: str, with_groups: bool) -> tuple[DataFrame, DataFrame]:
    """(rows, partial counts): each document's figures with its pairs, and in how many documents a task saw a pair."""
    held: dict[str, pa.Array] = {}
    figures = ["n_a", "n_b", "n_groups", "n_links"]
    names = ["row", "doc_id", *figures, "groups_sha256", *["groups"] * with_groups, "pairs", "times", "pair", "docs"]

    def columns(values: dict, count: int) -> pa.RecordBatch:
        empty = {"groups_sha256": pa.string(), "groups": pa.string(), "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int64())}
        return pa.RecordBatch.from_arrays(
            [values.get(n, pa.nulls(count, empty.get(n, pa.int64()))) for n in names], names=names
        )

    def partial(counted: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        whole = _added(counted, ["pair"], "docs") if counted else pa.table({"pair": [], "docs": []})
        for batch in whole.rename_columns(["pair", "docs"]).to_batches(max_chunksize=100_000):
            yield columns({n: batch.column(n).cast(pa.int64()) for n in ("pair", "docs")}, len(batch))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder_a, coder_b = _coders(path_a, path_b)
        width = len(coder_b.bytes)
        if not held:
            held["pool"] = _pool(max(len(coder_a.bytes), width))
        row, counted = TaskContext.get().partitionId() << 40, []
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                texts = pc.fill_null(part.column("text"), "")
                (ends_a, ids_a), (ends_b, ids_b) = coder_a.encode(texts), coder_b.encode(texts)
                told = [x.encode("utf-8", "surrogatepass") for x in with_space(texts).to_pylist()]
                valid = np.array(
                    [
                        len(x) > 1 and x == y == z
                        for x, y, z in zip(told, _joined(ends_a, ids_a, coder_a.bytes), _joined(ends_b, ids_b, coder_b.bytes))
                    ],
                    bool,
                )
                a, b = _Side(ends_a, ids_a, valid, coder_a.bytes), _Side(ends_b, ids_b, valid, coder_b.bytes)
                common = a.ends("a").join(b.ends("b"), ["doc", "end"], join_type="inner", use_threads=False)
                a.cut(np.asarray(common.column("a")))
                b.cut(np.asarray(common.column("b")))
                linked = _links(a, b, width)
                order = np.lexsort((np.asarray(linked.column("pair")), np.asarray(linked.column("doc"))))
                linked = linked.take(pa.array(order)).combine_chunks()
                doc, times = np.asarray(linked.column("doc")), np.asarray(linked.column("n"))
                counted.append(linked.select(["pair"]).group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "docs"]))
                if sum(map(len, counted)) > _HELD:
                    counted = [_added(counted, ["pair"], "docs").rename_columns(["pair", "docs"])]
                    if len(counted[0]) > _HELD // 2:
                        yield from partial(counted)
                        counted = []

                n, good = len(part), np.flatnonzero(valid)
                spread = {x: np.zeros(n, np.int64) for x in (*figures, "pairs")}
                spread["n_a"][good], spread["n_b"][good] = a.count, b.count
                spread["n_groups"][good] = np.bincount(np.asarray(a.doc)[a.last == 1], minlength=len(good))
                spread["n_links"][good] = np.bincount(doc, weights=times, minlength=len(good)).astype(np.int64)
                spread["pairs"][good] = np.bincount(doc, minlength=len(good))
                bounds = pa.array(np.concatenate([[0], np.cumsum(spread.pop("pairs"))]), pa.int32())
                written = dict(zip(good.tolist(), _written(a, b, held["pool"])))
                values = {x: pa.array(y) for x, y in spread.items()} | {
                    "row": pa.array(row + np.arange(n)),
                    "doc_id": part.column("key"),
                    "groups_sha256": pa.array([hashlib.sha256(written[i]).hexdigest() if i in written else "" for i in range(n)], pa.string()),
                    "pairs": pa.ListArray.from_arrays(bounds, linked.column("pair").combine_chunks()),
                    "times": pa.ListArray.from_arrays(bounds, linked.column("n").combine_chunks()),
                }
                if with_groups:
                    values["groups"] = pa.array([bytes(written.get(i, b"")).decode() for i in range(n)], pa.string())
                row += n
                yield columns(values, n)
        yield from partial(counted)

    shape = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    shape += "groups string, " * with_groups + "pairs array<bigint>, times array<bigint>, pair bigint, docs bigint"
    rows = docs.select(docs[key].cast("bigint").alias("key"), docs[text].cast("string").alias("text"))
    seen = stored(rows.mapInArrow(lean(align), shape), "crosstok-tokens")
    return seen.filter(F.col("row").isNotNull()).drop("pair", "docs"), seen.filter(F.col("pair").isNotNull()).select("pair", "docs")


def pair_counts(partial: DataFrame, width: int) -> DataFrame:
    """``pair, docs, best``: the documents that hold each pair linked, and whether no pair of its A id has more."""
    counts = partial.groupBy("pair").agg(F.sum("docs").alias("docs"))
    same = W.partitionBy(F.call_function("div", F.col("pair"), F.lit(width)))  # at most `width` rows, one for each B id
    return counts.withColumn("best", F.col("docs") == F.max("docs").over(same))


def _looked_up(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``n_best`` and ``count_sum`` by a table sent to the workers."""
    table = counts.toArrow()
    pair = np.asarray(table.column("pair"))
    order = np.argsort(pair)
    kept = (pair[order], np.asarray(table.column("docs"))[order].astype(np.int32 if len(order) == 0 or int(np.asarray(table.column("docs")).max()) < 2**31 else np.int64), np.asarray(table.column("best"))[order])
    sent = rows.sparkSession.sparkContext.broadcast(kept)
    names = [c for c in rows.columns if c not in ("row", "pairs", "times")]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, docs, best = sent.value
        for batch in batches:
            lists = batch.column("pairs")
            times = np.asarray(batch.column("times").flatten())
            at = np.searchsorted(pair, np.asarray(lists.flatten()))
            row = np.asarray(pc.list_parent_indices(lists))
            figures = [np.zeros(len(batch), np.int64) for _ in range(2)]
            np.add.at(figures[0], row, times * best[at])
            np.add.at(figures[1], row, times * docs[at])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], *map(pa.array, figures)], names=[*names, "n_best", "count_sum"]
            )

    shape = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInArrow(look, f"{shape}, n_best bigint, count_sum bigint")


def _looked_up_by_shuffle(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The same for a table of any size. A pair that many documents hold is split as a skewed join."""
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), "x.times")
    times = F.col("times")
    sums = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"), F.sum(times * F.col("docs")).alias("count_sum")
    )
    joined = rows.drop("pairs", "times").join(sums, "row", "left").drop("row")
    return joined.fillna(0, ["n_best", "count_sum"])


def align(
    docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", with_groups: bool = False, sent: int = SENT
) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum, and ``groups`` if asked for.

    Null and empty texts, and texts whose tokens' bytes differ from the space and the text, have no tokens: zeros and an
    empty ``groups_sha256``. Null keys and repeated rows keep their rows, each counting as a document; a very long text is
    one task's work, in memory proportional to its tokens, with its links joined in blocks; other columns are ignored; an
    empty table gives no rows.
    """
    rows, partial = _tokens(docs, path_a, path_b, key, text, with_groups)
    counts = stored(pair_counts(partial, len(SentencePieces(path_b).bytes)), "crosstok-counts")
    return _looked_up(rows, counts) if counts.count() <= sent else _looked_up_by_shuffle(rows, counts)
