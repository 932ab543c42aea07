"""Session settings for large inputs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the jobs are designed for. Adaptive execution picks join strategies by measured size,
# merges small shuffle partitions and splits skewed ones; RocksDB keeps streaming state off the
# heap and uploads only what a batch changed.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(name: str, **settings: str) -> SparkSession:
    """A session with the cluster settings; the master and resources come from spark-submit."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**CLUSTER_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
