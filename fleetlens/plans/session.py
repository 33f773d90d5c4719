"""Session settings this package is written for, and where lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_BASE = {
    "spark.sql.session.timeZone": "UTC",
    # AQE sizes the reduce side, splits skewed join partitions and turns joins whose real side is small
    # into broadcasts; the split must also happen where it costs a further exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keyed state of the stateful processors lives in RocksDB, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def settings(shuffle_partitions: int | None = None) -> dict[str, str]:
    """Settings for a cluster session; give ``shuffle_partitions`` as about 3x the total cores."""
    chosen = dict(_BASE)
    if shuffle_partitions is not None:
        chosen["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return chosen


def build_session(
    app: str = "fleetlens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**settings(shuffle_partitions), **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``; a temporary one only in local mode (tests)."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="fleetlens-"))
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of an expensive intermediate result that several steps read.

    Uses a reliable checkpoint, so the rows outlive the executors that made them.  Streams pass through.
    """
    if df.isStreaming:
        return df
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
