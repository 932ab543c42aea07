"""The shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


_MADE: list[tuple[SparkSession, str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach.

    It is removed when the driver ends. Without that setting only a local session, as in tests, gets
    one, in the machine's temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="trailmill-")
    folder = f"{shared.rstrip('/')}/trailmill/{name}-{uuid.uuid4().hex}"
    if not _MADE:
        atexit.register(_remove_all)
    _MADE.append((spark, folder))
    return folder


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder whose tables nobody reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def released() -> Iterator[None]:
    """Deletes the scratch tables made in its block when that ends: their results have then been written or taken."""
    before = len(_MADE)
    try:
        yield
    finally:
        for spark, folder in _MADE[before:]:
            remove(spark, folder)
        del _MADE[before:]


def _remove_all() -> None:
    for spark, folder in _MADE:
        with contextlib.suppress(Exception):  # the session may be gone
            remove(spark, folder)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder and read back.

    For a result that is used more than once, or joined with something much larger: it is computed
    once, survives lost executors, and Spark plans the join by its true size, so a small one is
    broadcast without the large side ever being shuffled.
    """
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
