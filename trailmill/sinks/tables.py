"""Writing result tables.

``append_rows`` and ``replace_slices`` are plain Spark writes. :class:`BatchTable` is the keyed
table of the streaming jobs. Parquet cannot update rows in place, and rewriting a whole table for
each micro-batch would cost more the longer it runs, so a batch only adds a folder holding the rows
it changed; the current row of a key is the one of its latest batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BATCH = "batch_id"


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append to a stored table; one batched write whatever the number of rows."""
    df.write.format(fmt).mode("append").save(path)


def replace_slices(df: DataFrame, path: str, parts: Sequence[str]) -> None:
    """Replace the slices (combinations of ``parts``) that ``df`` has rows in; others stay.

    Rows are gathered by slice to write few files; adaptive execution splits a large slice.
    """
    (
        df.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def read_slices(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table written by :func:`replace_slices`, in the column order of ``schema``."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def claim(spark: SparkSession, folder: str) -> None:
    """Batch ids mean something within one streaming query alone, which its checkpoint names.

    The first query to write is noted beside the table. Another one, such as the same job after its checkpoint was
    lost, would begin its ids anew, and its rows would pass for replays.
    """
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        return
    path = spark._jvm.org.apache.hadoop.fs.Path
    note = path(f"{folder}/_writer")
    fs = note.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(note):
        out = fs.create(note, False)
        out.writeBytes(query)
        out.close()
        return
    held = fs.open(note)
    known = spark._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
    held.close()
    if known != query:
        raise ValueError(f"{folder} is written by query {known}, not by {query}: its checkpoint was replaced")


@dataclass(frozen=True)
class BatchTable:
    """A table whose writers publish one folder per batch.

    A folder is written aside and renamed into place, so readers never see half a batch and a
    batch replayed after a failure is published once. There is one writer per table. Renaming is a
    single step on HDFS and on mounted file systems.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    files: int | None = None  # files per batch, for tests; None keeps the partitions of the rows

    # ---- layout --------------------------------------------------------------------------------
    def _fs(self, spark: SparkSession):
        path = spark._jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(spark._jsc.hadoopConfiguration()), path

    def batch_path(self, batch_id: int) -> str:
        return f"{self.path}/batch-{batch_id}"

    def _published(self, spark: SparkSession) -> tuple[int | None, list[int]]:
        """The newest snapshot, and the batches after it."""
        fs, path = self._fs(spark)
        if not fs.exists(path(self.path)):
            return None, []
        names = [status.getPath().getName() for status in fs.listStatus(path(self.path))]
        ids = {
            kind: [int(n[len(kind) :]) for n in names if n.startswith(kind)]
            for kind in ("snapshot-", "batch-")
        }
        newest = max(ids["snapshot-"], default=None)
        return newest, sorted(i for i in ids["batch-"] if newest is None or i > newest)

    def _stage(self, df: DataFrame, name: str) -> str:
        if self.files is not None:
            df = df.repartition(self.files, *self.keys)
        staged = f"{self.path}/_staging/{name}"
        df.write.mode("overwrite").parquet(staged)
        return staged

    def _show(self, spark: SparkSession, staged: str, name: str) -> None:
        fs, path = self._fs(spark)
        if not fs.rename(path(staged), path(f"{self.path}/{name}")):
            raise OSError(f"could not publish {name} of {self.path}")

    # ---- writing -------------------------------------------------------------------------------
    def create(self, spark: SparkSession) -> None:
        """Make the table's folder, so that a stream may read it before its first batch."""
        fs, path = self._fs(spark)
        fs.mkdirs(path(self.path))

    def publish(self, df: DataFrame, batch_id: int) -> bool:
        """Add the rows of a batch; false, and no change, if the batch is there already.

        The rows are computed either way: a replayed streaming batch has to run through its
        stateful operators before the stream may go on.
        """
        spark = df.sparkSession
        claim(spark, self.path)
        stamp = F.lit(batch_id).cast("bigint").alias(BATCH)
        staged = self._stage(df.select(*self.schema.names, stamp), f"batch-{batch_id}")
        if self.covers(spark, batch_id):
            fs, path = self._fs(spark)
            fs.delete(path(staged), True)
            return False
        self._show(spark, staged, f"batch-{batch_id}")
        return True

    def compact(self, spark: SparkSession, additive: bool = False) -> int | None:
        """Write the current rows as a snapshot that stands for all batches so far."""
        _, batches = self._published(spark)
        if not batches:
            return None
        # As many files as the rows need: adaptive execution sizes them.
        current = (self.totals(spark) if additive else self.latest(spark)).hint("rebalance")
        stamp = F.lit(batches[-1]).cast("bigint").alias(BATCH)
        name = f"snapshot-{batches[-1]}"
        self._show(spark, self._stage(current.select("*", stamp), name), name)
        return batches[-1]

    def vacuum(self, spark: SparkSession, keep: int = 0) -> int:
        """Delete the folders that a snapshot stands for.

        With ``keep``, that snapshot is the one so many before the newest, which leaves readers
        that started earlier the folders they are reading.
        """
        fs, path = self._fs(spark)
        folders = {s.getPath().getName(): s.getPath() for s in fs.listStatus(path(self.path))}
        numbered = [
            (kind, int(number), name)
            for name in folders
            for kind, _, number in [name.partition("-")]
            if kind in ("batch", "snapshot")
        ]
        snapshots = sorted((n for kind, n, _ in numbered if kind == "snapshot"), reverse=True)
        if len(snapshots) <= keep:
            return 0
        base = snapshots[keep]
        old = [
            name
            for kind, number, name in numbered
            if number < base or (kind == "batch" and number == base)
        ]
        for name in old:
            fs.delete(folders[name], True)
        return len(old)

    def forget(self, spark: SparkSession, before: int) -> int:
        """Delete the batches before the given one, of a table that is only passed on."""
        fs, path = self._fs(spark)
        old = [i for i in self._published(spark)[1] if i < before]
        for batch_id in old:
            fs.delete(path(self.batch_path(batch_id)), True)
        return len(old)

    def tidy(self, spark: SparkSession, every: int, additive: bool = False) -> None:
        """Once so many batches follow the last snapshot, write one and drop what the one before stands for."""
        if len(self._published(spark)[1]) >= every:
            self.compact(spark, additive)
            self.vacuum(spark, keep=1)

    # ---- reading -------------------------------------------------------------------------------
    def folders(self, spark: SparkSession) -> list[str]:
        """The newest snapshot and the batches after it."""
        snapshot, batches = self._published(spark)
        base = [] if snapshot is None else [f"{self.path}/snapshot-{snapshot}"]
        return base + [self.batch_path(i) for i in batches]

    def since_snapshot(self, spark: SparkSession) -> list[int]:
        """The batches after the newest snapshot."""
        return self._published(spark)[1]

    def newest(self, spark: SparkSession) -> int:
        """The last batch published, by itself or within a snapshot."""
        snapshot, batches = self._published(spark)
        return batches[-1] if batches else snapshot

    def covers(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether the batch is published, by itself or within a snapshot."""
        snapshot, batches = self._published(spark)
        return batch_id in batches or (snapshot is not None and batch_id <= snapshot)

    def began_before(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether a batch before the given one is published, by itself or within a snapshot older than that."""
        fs, path = self._fs(spark)
        if not fs.exists(path(self.path)):
            return False
        names = [status.getPath().getName().partition("-") for status in fs.listStatus(path(self.path))]
        return any(int(number) < batch_id for kind, _, number in names if kind in ("batch", "snapshot"))

    def changes(self, spark: SparkSession) -> DataFrame:
        """Every published row with its ``batch_id``."""
        folders = self.folders(spark)
        schema = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType(), True)])
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*folders)

    def has_batch(self, spark: SparkSession, batch_id: int) -> bool:
        return batch_id in self._published(spark)[1]

    def batch_rows(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows one batch published."""
        return spark.read.schema(self.schema).parquet(self.batch_path(batch_id))

    def latest_of(self, changes: DataFrame) -> DataFrame:
        values = [name for name in self.schema.names if name not in self.keys]
        rows = changes.groupBy(*self.keys).agg(
            *[F.max_by(name, BATCH).alias(name) for name in values], F.lit(True).alias("__row")
        )
        return rows.select(*self.schema.names)

    def latest(self, spark: SparkSession) -> DataFrame:
        """One row per key, that of its latest batch (upsert that replaces)."""
        return self.latest_of(self.changes(spark))

    def totals(self, spark: SparkSession) -> DataFrame:
        """One row per key with its values added up over the batches (upsert that adds)."""
        values = [name for name in self.schema.names if name not in self.keys]
        added = self.changes(spark).groupBy(*self.keys).agg(
            *[F.sum(name).alias(name) for name in values]
        )
        return added.select(*self.schema.names)


def upsert_table(
    df: DataFrame, path: str, keys: Sequence[str], batch_id: int, files: int | None = None
) -> BatchTable:
    """Upsert the rows of a batch, one row per key, and return the table."""
    table = BatchTable(path, df.schema, tuple(keys), files)
    table.publish(df, batch_id)
    return table
