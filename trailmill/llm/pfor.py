"""Token ids in patched frame-of-reference files.

A block holds 128 ids: their minimum, a bit width that covers nine tenths of the differences from it,
the low bits of all differences packed at that width, and a list of the exceptions whose differences
are wider. The index at the end of a file has the start of every block and of every document, so one
document can be read alone.

File, all little-endian: magic; blocks; block starts (u64 each); per document its id (i64), whether
the id is null (u8) and its start among the file's ids (u64); then ids, blocks, documents and the
index's place (u64 each) and the magic again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from . import files, tokens
from ..plans import scratch
from .common import lean, slices, stored

# Fixed values of the format.
MAGIC = b"TMPFOR1\n"
BLOCK = 128
PERCENTILE = 90
_HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("exceptions", "u1")])
_TAIL = np.dtype([("ids", "<u8"), ("blocks", "<u8"), ("docs", "<u8"), ("index", "<u8"), ("magic", "S8")])


def pack(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The blocks' bytes, and where each starts. The last block repeats its last id up to 128."""
    n = len(ids)
    if not n:
        return b"", np.zeros(0, np.int64)
    count = -(-n // BLOCK)
    full = np.empty(count * BLOCK, "<u4")
    full[:n], full[n:] = ids, ids[-1]
    full = full.reshape(count, BLOCK)
    least = full.min(axis=1)
    above = full - least[:, None]
    at = BLOCK * PERCENTILE // 100
    width = _bits(np.partition(above, at, axis=1)[:, at])
    wide = above >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    exceptions = wide.sum(axis=1)
    sizes = _HEAD.itemsize + BLOCK // 8 * width.astype(np.int64) + 5 * exceptions
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    head = np.zeros(count, _HEAD)
    head["least"], head["width"], head["exceptions"] = least, width, exceptions
    out[starts[:, None] + np.arange(_HEAD.itemsize)] = head.view(np.uint8).reshape(count, -1)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        packed = _packed(above[rows], int(w))
        out[(starts[rows] + _HEAD.itemsize)[:, None] + np.arange(packed.shape[1])] = packed
    row, place = np.nonzero(wide)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        body = starts[row] + _HEAD.itemsize + BLOCK // 8 * width[row].astype(np.int64)
        out[body + nth] = place
        values = np.ascontiguousarray(above[row, place], "<u4").view(np.uint8).reshape(-1, 4)
        out[(body + exceptions[row] + 4 * nth)[:, None] + np.arange(4)] = values
    return out.tobytes(), starts


def _packed(values: np.ndarray, w: int) -> np.ndarray:
    """The low ``w`` bits of each value of the blocks, end to end. Eight values fill ``w`` bytes, so each of the eight is shifted
    to its place in all groups at once."""
    low = (values & np.uint32((1 << w) - 1)).astype(np.uint64).reshape(len(values), BLOCK // 8, 8)
    out = np.zeros((len(values), BLOCK // 8, w), np.uint8)
    for i in range(8):
        at, shift = divmod(i * w, 8)
        moved = low[:, :, i] << np.uint64(shift)
        for k in range(-(-(shift + w) // 8)):
            out[:, :, at + k] |= ((moved >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8)
    return out.reshape(len(values), -1)


def _unpacked(packed: np.ndarray, w: int) -> np.ndarray:
    """The values that :func:`_packed` took."""
    groups = packed.reshape(len(packed), BLOCK // 8, w)
    out = np.empty((len(packed), BLOCK // 8, 8), np.uint32)
    for i in range(8):
        at, shift = divmod(i * w, 8)
        held = np.zeros(groups.shape[:2], np.uint64)
        for k in range(-(-(shift + w) // 8)):
            held |= groups[:, :, at + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, :, i] = (held >> np.uint64(shift)) & np.uint64((1 << w) - 1)
    return out.reshape(len(packed), BLOCK)


def _bits(values: np.ndarray) -> np.ndarray:
    """The number of bits each value takes."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def unpack(data: bytes, starts: np.ndarray) -> np.ndarray:
    """All ids of the blocks that begin at ``starts`` in ``data``, 128 for each block."""
    raw = np.frombuffer(data, np.uint8)
    starts = np.asarray(starts, np.int64)
    if not len(starts):
        return np.zeros(0, "<u4")
    head = raw[starts[:, None] + np.arange(_HEAD.itemsize)].copy().view(_HEAD)[:, 0]
    width, exceptions = head["width"].astype(np.int64), head["exceptions"].astype(np.int64)
    above = np.zeros((len(starts), BLOCK), "<u4")
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        packed = raw[(starts[rows] + _HEAD.itemsize)[:, None] + np.arange(BLOCK // 8 * w)]
        above[rows] = _unpacked(packed, int(w))
    total = int(exceptions.sum())
    if total:
        row = np.repeat(np.arange(len(starts)), exceptions)
        nth = np.arange(total) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        body = starts[row] + _HEAD.itemsize + BLOCK // 8 * width[row]
        values = raw[(body + exceptions[row] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
        above[row, raw[body + nth]] = values
    return (above + head["least"][:, None]).reshape(-1)


class Writer:
    """Writes one file; blocks leave memory as they fill."""

    def __init__(self, uri: str):
        self.out = files.open_output(uri)
        self.out.write(MAGIC)
        self.at, self.ids, self.rest = len(MAGIC), 0, np.zeros(0, "<u4")
        self.blocks, self.keys, self.nulls, self.starts = [], [], [], []

    def add(self, keys: np.ndarray, nulls: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> None:
        """Documents with their ids laid end to end; document i begins at offsets[i]."""
        self.keys.append(keys.astype("<i8"))
        self.nulls.append(nulls.astype(np.uint8))
        self.starts.append((offsets[:-1] + self.ids).astype("<u8"))
        self.ids += len(ids)
        held = np.concatenate([self.rest, ids])
        cut = len(held) // BLOCK * BLOCK
        self._write(held[:cut])
        self.rest = held[cut:]

    def _write(self, ids: np.ndarray) -> None:
        data, starts = pack(ids)
        self.blocks.append((starts + self.at).astype("<u8"))
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        self._write(self.rest)
        sizes = [sum(map(len, x)) for x in (self.blocks, self.keys)]
        for parts in (self.blocks, self.keys, self.nulls, self.starts):
            for part in parts:
                self.out.write(part.tobytes())
        tail = np.array([(self.ids, *sizes, self.at, MAGIC)], _TAIL)
        self.out.write(tail.tobytes())
        self.out.close()


class Reader:
    """Reads one file, whole or some documents of it."""

    def __init__(self, uri: str):
        self.file = files.open_input(uri)
        end = self.file.size() - _TAIL.itemsize
        tail = np.frombuffer(self._read(end, _TAIL.itemsize), _TAIL)[0]
        if tail["magic"] != MAGIC.rstrip(b"\0"):
            raise ValueError(f"{uri} is not a file of this format")
        self.ids, blocks, docs, index = (int(tail[k]) for k in ("ids", "blocks", "docs", "index"))
        held = self._read(index, end - index)
        self.blocks = np.frombuffer(held, "<u8", blocks).astype(np.int64)
        self.keys = np.frombuffer(held, "<i8", docs, 8 * blocks)
        self.nulls = np.frombuffer(held, "u1", docs, 8 * (blocks + docs)).astype(bool)
        starts = np.frombuffer(held, "<u8", docs, 8 * (blocks + docs) + docs).astype(np.int64)
        self.starts, self.end = np.append(starts, self.ids), index

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def documents(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the documents first <= i < last; only their blocks are read."""
        start, end = int(self.starts[first]), int(self.starts[last])
        low, high = start // BLOCK, -(-end // BLOCK)
        if low >= high:
            return self.starts[first : last + 1] - start, np.zeros(0, "<u4")
        stop = int(self.blocks[high]) if high < len(self.blocks) else self.end
        at = int(self.blocks[low])
        ids = unpack(self._read(at, stop - at), self.blocks[low:high] - at)
        return self.starts[first : last + 1] - start, ids[start - low * BLOCK : end - low * BLOCK]

    def groups(self, ids: int = 1_000_000) -> Iterator[tuple[int, int]]:
        """Ranges of documents with about so many ids each."""
        part = self.starts[:-1] // ids
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(self.keys)]
        yield from ((a, b) for a, b in zip(cuts, cuts[1:]) if b > a)


_MANIFEST = "part int, file string, docs bigint, ids bigint, first bigint"


def write_tokens(
    docs: DataFrame, path: str, folder: str, end_id: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode every text, append ``end_id``, and write the ids in ascending key order to ``folder``.

    Returns the manifest, stored: a row for each file that a finished task wrote, with ``before``, the
    ids of all files before it. Files of lost attempts are in no manifest. Ranges of the key and a hash
    of the text make the files, so rows that repeat one key spread too; null keys come first; a null
    text is empty and has the end id alone.
    """
    rows = docs.select(
        docs[key].cast("bigint").alias("key"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, docs_written = None, 0
        coder, part = tokens.encoder(path), TaskContext.get().partitionId()
        for batch in batches:
            for piece in slices(batch, "text"):
                if writer is None:
                    uri = f"{folder}/{files.fresh_name(f'part-{part:06d}', '.pfor')}"
                    writer, first = Writer(uri), piece.column("key")[0].as_py()
                offsets, ids = with_end(*coder.encode(piece.column("text")), end_id)
                keys = piece.column("key")
                writer.add(
                    np.asarray(keys.fill_null(0)), np.asarray(keys.is_null()), offsets, ids
                )
                docs_written += len(piece)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "file": uri, "docs": docs_written, "ids": writer.ids, "first": first}],
                schema=pa.schema(
                    [("part", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64()), ("first", pa.int64())]
                ),
            )

    manifest = stored(ordered.select("key", "text").mapInArrow(lean(write), _MANIFEST), "pfor-manifest")
    # One row for each file: the running total over them is small.
    so_far = W.orderBy(F.col("first").asc_nulls_first(), "part").rowsBetween(W.unboundedPreceding, -1)
    return manifest.withColumn("before", F.coalesce(F.sum("ids").over(so_far), F.lit(0)))


def with_end(offsets: np.ndarray, ids: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each document's."""
    count = len(offsets) - 1
    moved = offsets + np.arange(count + 1)
    out = np.full(len(ids) + count, end_id, "<u4")
    keep = np.ones(len(out), bool)
    keep[moved[1:] - 1] = False
    out[keep] = ids
    return moved, out


def read_tokens(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    (of the ids as little-endian 32-bit), and the ids themselves unless ``with_ids`` is false."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for uri, before in zip(frame.column("file").to_pylist(), frame.column("before").to_pylist()):
                reader = Reader(uri)
                for first, last in reader.groups():
                    offsets, ids = reader.documents(first, last)
                    raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
                    columns = [
                        pa.array(reader.keys[first:last], mask=reader.nulls[first:last]),
                        pa.array(reader.starts[first:last] + before),
                        pa.array(np.diff(offsets)),
                        pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(offsets.astype(np.int32), ids.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    shape = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    tasks = max(1, manifest.count())  # a number asked for is kept: small rows would all be merged into one task
    return manifest.select("file", "before").repartitionByRange(tasks, "before").mapInArrow(read, shape)


def new_folder(spark) -> str:
    return scratch.new_folder(spark, "llm-pfor")
