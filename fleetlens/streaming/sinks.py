"""Sinks.  Every query keeps offsets and state under its own checkpoint folder and may be restarted there.

Tables are parquet folders with one ``batch_id=N`` partition per micro-batch where a batch may be
replayed: the replay overwrites its own partition, so the table stays exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

TRIGGER_INTERVAL = "5 seconds"


def _start(writer: DataStreamWriter, checkpoint: str, drain: bool) -> StreamingQuery:
    """Start a query; ``drain`` works off what is there and ends, else it runs every five seconds."""
    writer = writer.option("checkpointLocation", checkpoint)
    if not drain:
        return writer.trigger(processingTime=TRIGGER_INTERVAL).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def print_table(df: DataFrame, rows: int = 20) -> None:
    df.show(rows, truncate=False)


def print_stream(df: DataFrame, checkpoint: str, mode: str = "append", drain: bool = False) -> StreamingQuery:
    """Write every micro-batch to the console."""
    return _start(df.writeStream.outputMode(mode).format("console").option("truncate", False), checkpoint, drain)


def write_append(df: DataFrame, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Insert-only result into a parquet table."""
    return _start(df.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint, drain)


def _write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def _each_batch(
    df: DataFrame, mode: str, act: Callable[[DataFrame, int], None], checkpoint: str, drain: bool
) -> StreamingQuery:
    return _start(df.writeStream.outputMode(mode).foreachBatch(act), checkpoint, drain)


def write_updates(df: DataFrame, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Changed rows of a running aggregate, one partition per micro-batch; see :func:`read_current`."""
    return _each_batch(df, "update", lambda batch, n: _write_batch(batch, path, n), checkpoint, drain)


def read_current(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row per key of a table written by :func:`write_updates`."""
    changes = spark.read.parquet(path)
    rest = [c for c in changes.columns if c not in (*keys, "batch_id")]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def write_routed(
    tagged: DataFrame, routes: Callable[[DataFrame], dict[str, DataFrame]], path: str, checkpoint: str,
    drain: bool = False,
) -> StreamingQuery:
    """Side outputs: each table of ``routes(batch)`` goes to its own folder, from one computed batch."""

    def act(batch: DataFrame, n: int) -> None:
        batch.persist()
        try:
            for name, rows in routes(batch).items():
                _write_batch(rows, f"{path}/{name}", n)
        finally:
            batch.unpersist()

    return _each_batch(tagged, "append", act, checkpoint, drain)


def append_latest(latest: DataFrame, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Keep the table of ``latest_per_vehicle`` up to date from a stream of it."""
    return write_updates(latest, path, checkpoint, drain)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    return read_current(spark, path, ["vehicle_id"])


def compact_latest(spark: SparkSession, path: str, target: str) -> None:
    """Write the newest row per vehicle as a fresh table without the history."""
    read_latest(spark, path).withColumn("batch_id", F.lit(-1)).write.partitionBy("batch_id").mode(
        "overwrite").parquet(target)
