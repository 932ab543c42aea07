"""A keyed table in folders by day, for streams whose state closes day by day.

Each day is a :class:`~.tables.BatchTable` of its own. A batch adds a folder to the days it has rows in, and reads,
compacts and lists those alone. A day behind the watermark gets no more rows: it is closed, which leaves one
snapshot that is never rewritten. Which days are open is noted in a small folder, so nothing depends on how many
days the table has seen.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .tables import BATCH, BatchTable, claim

_DAY = "day="


@dataclass(frozen=True)
class DayTable:
    """``schema`` has the text column ``date`` (yyyy-MM-dd), which is one of the ``keys``."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    files: int | None = None

    def day(self, day: str) -> BatchTable:
        return BatchTable(f"{self.path}/{_DAY}{day}", self.schema, self.keys, self.files)

    # ---- which days ----------------------------------------------------------------------------
    def _fs(self, spark: SparkSession):
        path = spark._jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(spark._jsc.hadoopConfiguration()), path

    def _named(self, spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
        fs, path = self._fs(spark)
        if not fs.exists(path(folder)):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(path(folder))]
        return sorted(n[len(prefix) :] for n in names if n.startswith(prefix) and not n.endswith(".crc"))

    def days(self, spark: SparkSession) -> list[str]:
        """Every day there are rows of. One folder is listed."""
        return self._named(spark, self.path, _DAY)

    def open_days(self, spark: SparkSession) -> list[str]:
        return self._named(spark, f"{self.path}/_open")

    def newest_before(self, spark: SparkSession, batch_id: int) -> str | None:
        """The newest open day that a batch before the given one has rows of. A batch replayed gets the same answer."""
        return next((day for day in reversed(self.open_days(spark)) if self.day(day).began_before(spark, batch_id)), None)

    def create(self, spark: SparkSession) -> None:
        fs, path = self._fs(spark)
        fs.mkdirs(path(self.path))

    # ---- writing -------------------------------------------------------------------------------
    def publish(self, df: DataFrame, batch_id: int) -> list[str]:
        """Add the rows of a batch, computed once, and return its days.

        A batch's days appear one after the other, each at once. A batch replayed adds the days that are missing and
        changes no others. Rows for a day that is closed are refused, unless the day has that batch already.
        """
        spark = df.sparkSession
        fs, path = self._fs(spark)
        claim(spark, self.path)
        rows = df.select(*self.schema.names, F.lit(batch_id).cast("bigint").alias(BATCH), F.col("date").alias("day"))
        if self.files is not None:
            rows = rows.repartition(self.files, *self.keys)
        staged = f"{self.path}/_staging/batch-{batch_id}"
        rows.write.mode("overwrite").partitionBy("day").parquet(staged)
        found = self._named(spark, staged, _DAY)
        for day in found:
            table, marker = self.day(day), path(f"{self.path}/_open/{day}")
            if table.covers(spark, batch_id):
                continue
            if not fs.exists(marker):
                if fs.exists(path(table.path)):
                    raise ValueError(f"{day} of {self.path} is closed: batch {batch_id} has rows behind the watermark")
                fs.create(marker, True).close()
                fs.mkdirs(path(table.path))
            if not fs.rename(path(f"{staged}/{_DAY}{day}"), path(table.batch_path(batch_id))):
                raise OSError(f"could not publish batch {batch_id} of {table.path}")
        fs.delete(path(staged), True)
        return found

    def _compact(self, spark: SparkSession, days: list[str]) -> None:
        """One job writes a snapshot of every one of the days."""
        if not days:
            return
        newest = {day: self.day(day).newest(spark) for day in days}
        # A stamp that is no later than any day's last batch; as many files as the rows need.
        stamp = F.lit(min(newest.values())).cast("bigint").alias(BATCH)
        rows = self.latest(spark, days).select("*", stamp, F.col("date").alias("day")).hint("rebalance", "day")
        staged = f"{self.path}/_staging/snapshot-{max(newest.values())}"
        rows.write.mode("overwrite").partitionBy("day").parquet(staged)
        fs, path = self._fs(spark)
        for day, batch_id in newest.items():
            if not fs.rename(path(f"{staged}/{_DAY}{day}"), path(f"{self.day(day).path}/snapshot-{batch_id}")):
                raise OSError(f"could not publish a snapshot of {self.day(day).path}")
        fs.delete(path(staged), True)

    def tidy(self, spark: SparkSession, days: Iterable[str], every: int) -> None:
        """Compact those of the days that have so many batches since their last snapshot, and drop what the one before stands for."""
        full = [day for day in days if len(self.day(day).since_snapshot(spark)) >= every]
        self._compact(spark, full)
        for day in full:
            self.day(day).vacuum(spark, keep=1)

    def close(self, spark: SparkSession, before: str) -> list[str]:
        """Close the open days before the given one, in two calls: the first writes the days' last snapshots, the next one,
        when readers of the folders they replace are done, deletes these. A day in one folder needs no snapshot. Returns
        the days that are closed now."""
        fs, path = self._fs(spark)
        closed, many = [], []
        for day in self.open_days(spark):
            if day < before:
                table = self.day(day)
                if len(table.folders(spark)) > 1:
                    many.append(day)
                    continue
                table.vacuum(spark)
                fs.delete(path(f"{self.path}/_open/{day}"), False)
                closed.append(day)
        self._compact(spark, many)
        return closed

    # ---- reading -------------------------------------------------------------------------------
    def _read(self, spark: SparkSession, folders: list[str], stamped: bool) -> DataFrame:
        stamp = [T.StructField(BATCH, T.LongType(), True)] if stamped else []
        schema = T.StructType([*self.schema.fields, *stamp])
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*folders)

    def changes(self, spark: SparkSession, days: Iterable[str] | None = None) -> DataFrame:
        """The published rows of the days (all, if none are named) with their ``batch_id``, older ones merged."""
        chosen = self.days(spark) if days is None else days
        return self._read(spark, [f for day in chosen for f in self.day(day).folders(spark)], True)

    def batch_rows(self, spark: SparkSession, batch_id: int, days: Iterable[str]) -> DataFrame:
        """What one batch published. Of a day where a snapshot has taken it in, a replay gets all rows."""
        tables = [self.day(day) for day in days]
        folders = [
            f for table in tables
            for f in ([table.batch_path(batch_id)] if table.has_batch(spark, batch_id) else table.folders(spark))
        ]
        return self._read(spark, folders, False)

    def latest(self, spark: SparkSession, days: Iterable[str] | None = None) -> DataFrame:
        """One row per key, that of its latest batch."""
        whole = BatchTable(self.path, self.schema, self.keys)
        return whole.latest_of(self.changes(spark, days))


def open_from(spark: SparkSession, newest: str, watermark: str) -> str:
    """The first day that may still get rows once the watermark has seen ``newest``: it is no earlier than that day's
    beginning less the delay. What the next batch brings is held against the watermark of this one, which has seen the
    batches before it alone (:meth:`DayTable.newest_before`)."""
    start = F.to_timestamp(F.lit(newest), "yyyy-MM-dd") - F.expr(f"INTERVAL {watermark}")
    # One row without a source: no job runs for it.
    return spark.sql("SELECT 1 AS one").select(F.date_format(start, "yyyy-MM-dd").alias("day")).first()["day"]
