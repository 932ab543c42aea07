"""WARC archives as a Spark data source.

``spark.read.format("warc").load(folder)`` plans one partition for each archive file. Record headers are parsed first;
conditions on the record type and on other header fields are pushed down, and a record they rule out is skipped by its length,
so its payload is neither read into memory nor decoded. With the option ``payload`` = false no payload is.
``df.write.format("warc")`` writes response and revisit records, each body compressed by itself.

Every job that writes to a folder leaves a manifest of its own, which names the files of its finished tasks: appending adds
one, overwriting takes the earlier ones away once the new one stands. Files of lost attempts are in no manifest and never read.
"""

from __future__ import annotations

import gzip
import json
import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from . import files
from ..plans import scratch
from .common import reach_package, stored

# The layout of a record, and the least payload that a later record may refer back to.
VERSION = b"WARC/1.1\r\n"
LEAST_SHARED = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = ".warc-manifest.json"
# A file is closed once it holds so much, and the next one begun.
FILE_BYTES = 128 << 20

SCHEMA = (
    "page_id bigint, record_type string, record_id string, target_uri string, refers_to bigint, "
    "payload_digest string, payload_bytes bigint, payload binary, offset bigint"
)
# Columns that header fields answer: these conditions are pushed down.
RANGES = {GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le}
RANGED = ("page_id", "refers_to", "payload_bytes")  # numbers; Spark orders text otherwise than Python
PUSHED = ("record_type", "page_id", "target_uri", "payload_digest", "refers_to", "payload_bytes", "record_id")


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _header_text(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def write_record(page_id: int | None, uri: str | None, kind: str, digest: str, size: int, payload: bytes | None, refers_to: int | None) -> bytes:
    """One record. A revisit has the response's digest and size and no body."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if payload is None:
        block = http + b"\r\n"
    else:
        body = gzip.compress(payload, 1, mtime=0)
        block = http + b"Content-Encoding: gzip\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_name(page_id)), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if uri is not None:
        fields.append(("WARC-Target-URI", _header_text(uri)))
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(size))]
    if kind == "revisit":
        fields += [("WARC-Refers-To", record_name(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass")
    return VERSION + head + b"\r\n" + block + b"\r\n\r\n"


class Archive:
    """Reads one archive front to back, in pieces; unwanted blocks are passed over."""

    def __init__(self, uri: str, piece: int = 1 << 20):
        self.file, self.piece = files.open_input(uri), piece
        self.size, self.at, self.held, self.start = self.file.size(), 0, b"", 0

    def _fill(self, at: int, size: int) -> bytes:
        """Bytes from ``at`` on: at least ``size`` of them, unless the file ends."""
        low = at - self.start
        if low < 0 or low + size > len(self.held):
            self.file.seek(at)
            self.held, self.start, low = self.file.read(max(size, self.piece)), at, 0
        return self.held[low:]

    def headers(self) -> Iterator[tuple[int, dict[str, str], int, int]]:
        """(offset, header fields, start of the block, its length) of every record."""
        while self.at < self.size:
            head, size = self._fill(self.at, 4_096), 4_096
            while (end := head.find(b"\r\n\r\n")) < 0 and self.at + size < self.size:
                size *= 2
                head = self._fill(self.at, size)
            if end < 0 or not head.startswith(b"WARC/"):
                raise ValueError(f"no record at byte {self.at}")
            lines = head[:end].decode("utf-8", "surrogatepass").split("\r\n")[1:]
            fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            length, block = int(fields["content-length"]), self.at + end + 4
            yield self.at, fields, block, length
            self.at = block + length + 4

    def payload(self, block: int, length: int) -> bytes:
        """The decoded body of a record's HTTP message."""
        head, _, body = self._fill(block, length)[:length].partition(b"\r\n\r\n")
        return zlib.decompress(body, 31) if b"content-encoding: gzip" in head.lower() else body


def _row_of(fields: dict[str, str], offset: int) -> dict:
    digest = fields.get("warc-payload-digest", "")
    size = fields.get("x-payload-length")
    return {
        "page_id": _page_of(fields.get("warc-record-id")),
        "record_type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": _page_of(fields.get("warc-refers-to")),
        "payload_digest": digest.removeprefix("sha256:") or None,
        "payload_bytes": int(size) if size else None,
        "payload": None,
        "offset": offset,
    }


@dataclass
class FilePartition(InputPartition):
    uri: str


class WarcReader(DataSourceReader):
    def __init__(self, options, schema):
        self.folder = options["path"]
        self.wants_payload = options.get("payload", "true").lower() != "false"
        self.names = schema.names
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name in PUSHED and isinstance(f, EqualTo):
                self.tests.append((name, "in", (f.value,)))
            elif name in PUSHED and isinstance(f, In):
                self.tests.append((name, "in", tuple(f.value)))
            elif name in PUSHED and isinstance(f, IsNotNull):
                self.tests.append((name, "given", None))
            elif name in RANGED and type(f) in RANGES and f.value is not None:
                self.tests.append((name, RANGES[type(f)], f.value))
            else:
                yield f

    def partitions(self):
        return [FilePartition(uri) for uri in manifest_files(self.folder)]

    def _passes(self, row: dict) -> bool:
        for name, kind, wanted in self.tests:
            value = row[name]
            if value is None or (kind == "in" and value not in wanted) or (callable(kind) and not kind(value, wanted)):
                return False
        return True

    def read(self, partition):
        if partition is None:  # a folder without archives is planned as one empty partition
            return
        archive, rows, held = Archive(partition.uri), [], 0
        for offset, fields, block, length in archive.headers():
            row = _row_of(fields, offset)
            if not self._passes(row):
                continue
            if self.wants_payload and row["record_type"] == "response":
                row["payload"] = archive.payload(block, length)
                held += len(row["payload"])
            rows.append(row)
            if len(rows) >= 4_096 or held >= 8 << 20:
                yield _batch(rows, self.names)
                rows, held = [], 0
        if rows:
            yield _batch(rows, self.names)


_TYPES = {
    "page_id": pa.int64(), "record_type": pa.string(), "record_id": pa.string(), "target_uri": pa.string(), "refers_to": pa.int64(),
    "payload_digest": pa.string(), "payload_bytes": pa.int64(), "payload": pa.binary(), "offset": pa.int64(),
}


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], _TYPES[n]) for n in names], names=names)


def manifest_files(folder: str) -> list[str]:
    """The archives in a folder: those its manifests name, or all if it was written elsewhere."""
    found = files.listed(folder, MANIFEST)
    if not found:
        return [uri for uri, _ in files.listed(folder, ".warc")]
    names = []
    for uri, _ in found:
        with files.open_input(uri) as f:
            names += json.loads(f.read())
    return [f"{folder.rstrip('/')}/{name}" for name in sorted(names)]


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.folder, self.overwrite = options["path"].rstrip("/"), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        names, out, size = [], None, 0
        columns = ("page_id", "target_uri", "record_type", "payload_digest", "payload_bytes", "payload", "refers_to")
        for batch in iterator:
            for values in zip(*(batch.column(c).to_pylist() for c in columns)):
                if out is None:
                    names.append(files.fresh_name("pages", ".warc"))
                    out, size = files.open_output(f"{self.folder}/{names[-1]}"), 0
                record = write_record(*values)
                out.write(record)
                size += len(record)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages) -> None:
        earlier = [uri for uri, _ in files.listed(self.folder, MANIFEST)] if self.overwrite and files.exists(self.folder) else []
        names = sorted(n for m in messages if m is not None for n in m.names)
        with files.open_output(f"{self.folder}/{files.fresh_name('job', MANIFEST)}") as f:
            f.write(json.dumps(names).encode())
        for uri in earlier:
            files.delete(uri)

    def abort(self, messages) -> None:
        """Without a manifest of its own nothing of the job counts."""


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    reach_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records(pages: DataFrame, key: str = "page_id", uri: str = "url", html: str = "html") -> DataFrame:
    """The records to write, one for each row: of equal payloads of LEAST_SHARED bytes or more the least key's is the
    response and the others revisit it; every smaller payload is a response. A null html is empty.

    Rows with a null key are responses and are referred to by none; if the least key is repeated, each of its
    rows is a response.
    """
    payload = F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(uri).cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.length("payload").cast("bigint")).withColumn("payload_digest", F.sha2("payload", 256))
    # Only digests and keys are shuffled for the least key of each payload; the minimum is combined on the map side.
    large = rows.filter((F.col("payload_bytes") >= LEAST_SHARED) & F.col("page_id").isNotNull())
    shared = large.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    shared = stored(shared, "warc-shared")
    joined = rows.join(shared, "payload_digest", "left")
    again = F.col("first").isNotNull() & F.col("page_id").isNotNull() & (F.col("page_id") != F.col("first"))
    return joined.select(
        "page_id", "target_uri",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("payload_digest"), "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def write(pages: DataFrame, folder: str, mode: str = "append") -> None:
    """Add archives to a folder, or with the mode ``overwrite`` put them in the place of those it has.

    Revisits refer to responses of the same job. A manifest that is there is whole: it is written last.
    """
    register(pages.sparkSession)
    records(pages).write.format("warc").mode(mode).save(folder)


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """Records of a folder; filter the result by header columns to skip records unread."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


def checked(archive: DataFrame) -> DataFrame:
    """Page by page what the archives say, with size and digest taken from the decoded payload where the record has one."""
    return archive.select(
        "page_id",
        F.coalesce(F.length("payload").cast("bigint"), F.col("payload_bytes")).alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def new_folder(spark: SparkSession) -> str:
    return scratch.new_folder(spark, "llm-warc")
