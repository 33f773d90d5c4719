"""Results per record and per window on streams, with what crosses micro-batches in keyed tables.

Each micro-batch runs the table form of the analysis on its own rows, in order of arrival, behind one row per
sensor that carries what came before it.  A sensor that holds a third of all rows is cut into slices as in the
table form.  What is carried (one row per sensor, or per sensor and window) is in a
:class:`~fleetlens.streaming.keyed.KeyedTable` below ``path``; results are partitions ``batch_id=n``, which a
replay overwrites.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from fleetlens.operators.lateness import mark_late
from fleetlens.operators.rolling import add_totals, best_so_far, mean_so_far, mean_totals, winners
from fleetlens.operators.windows import means_of_totals, window_totals
from fleetlens.plans.slices import ROWS_PER_SLICE
from fleetlens.schemas import MEASUREMENT, WATERMARK_DELAY
from fleetlens.streaming.keyed import BUCKETS, KeyedTable, read_upserts
from fleetlens.streaming.sinks import _each_batch, _write_batch

_EVERYTHING = "all_sensors"
_NOTE_BUCKETS = 256  # a note rewrites one of them


def _read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def running_mean_in_batches(
    measurements: DataFrame, path: str, checkpoint: str, every: int = 1, compat: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE, buckets: int = BUCKETS, drain: bool = False,
) -> StreamingQuery:
    """``running_mean`` of a stream: a row at every ``every``-th record, also across micro-batches.

    Read the rows with :func:`read_running_means`.  ``compat=True`` keeps one mean over all sensors.
    """

    def act(batch: DataFrame, n: int) -> None:
        carried = KeyedTable(batch.sparkSession, f"{path}/totals", (_EVERYTHING if compat else "sensor_id",), buckets)
        rows = batch.select("ts", "sensor_id", "value", "seq").persist()
        try:
            fresh = mean_totals(rows)
            before = carried.read_before(n)
            if compat:
                sums = add_totals(["total", "n", "ts"])
                fresh = fresh.groupBy(F.lit(0).alias(_EVERYTHING)).agg(*[c.alias(name) for name, c in sums.items()])
                known = before.select(F.lit(0).cast("long").alias("sensor_id"), "total", "n", "ts") if before is not None else None
            else:
                known = before.join(fresh, "sensor_id", "left_semi") if before is not None else None
            _write_batch(mean_so_far(rows, known, every, compat, rows_per_slice), f"{path}/means", n)
            carried.merge(fresh, n, add_totals)
        finally:
            rows.unpersist()

    return _each_batch(measurements, "append", act, checkpoint, drain)


def read_running_means(spark: SparkSession, path: str) -> DataFrame:
    return _read_results(spark, f"{path}/means")


def changelog_in_batches(
    measurements: DataFrame, path: str, checkpoint: str, rule: str = "max_last",
    rows_per_slice: int = ROWS_PER_SLICE, buckets: int = BUCKETS, drain: bool = False,
) -> StreamingQuery:
    """``reading_changelog`` of a stream: one row per record with the winner so far under ``rule``.

    The winner of a sensor is carried to the next micro-batch with its own arrival number, so ties are decided
    as in one table.  Read the rows with :func:`read_changelog`, the winners with :func:`read_winners`.
    """

    def act(batch: DataFrame, n: int) -> None:
        carried = KeyedTable(batch.sparkSession, f"{path}/winners", ("sensor_id",), buckets)
        rows = batch.select(*MEASUREMENT.names).persist()
        try:
            before = carried.read_before(n)
            known = before.join(rows, "sensor_id", "left_semi").select(*MEASUREMENT.names) if before is not None else None
            _write_batch(best_so_far(rows, known, rule, rows_per_slice), f"{path}/changes", n)
            carried.merge(winners(rows if known is None else rows.unionByName(known), rule), n)
        finally:
            rows.unpersist()

    return _each_batch(measurements, "append", act, checkpoint, drain)


def read_changelog(spark: SparkSession, path: str) -> DataFrame:
    return _read_results(spark, f"{path}/changes")


def read_winners(spark: SparkSession, path: str) -> DataFrame:
    """The winner of each sensor now."""
    return read_upserts(spark, f"{path}/winners", ["sensor_id"])


def window_totals_in_batches(
    measurements: DataFrame, path: str, checkpoint: str, size: str = "10 seconds", slide: str = "5 seconds",
    clock: Callable[[], dt.datetime] | None = None, buckets: int = BUCKETS, drain: bool = False,
) -> StreamingQuery:
    """Sums per sensor and window that every micro-batch adds to, so late files still count in their window.

    Without ``clock`` windows go by event time.  With it they go by processing time: a micro-batch asks the clock
    once, notes the answer beside its number before it uses it, and a replay takes the noted one.
    Read the means with :func:`read_window_means`, the notes with :func:`read_clock`.
    """

    def act(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        table = KeyedTable(spark, f"{path}/totals", ("sensor_id", "window_start", "window_end"), buckets)
        timed, time = batch, "ts"
        if clock is not None:
            timed, time = batch.withColumn("_now", F.lit(_noted(spark, f"{path}/clock", n, clock))), "_now"
        table.merge(window_totals(timed, size, slide, time), n, add_totals)

    return _each_batch(measurements, "append", act, checkpoint, drain)


def _noted(spark: SparkSession, path: str, n: int, clock: Callable[[], dt.datetime]) -> dt.datetime:
    """The time of micro-batch ``n``: what it was given first."""
    notes = KeyedTable(spark, path, ("batch_id",), _NOTE_BUCKETS)
    rows = notes.read()
    known = rows.where(F.col("batch_id") == n).select("now").head() if rows is not None else None
    if known:
        return known["now"]
    made = spark.createDataFrame([(n, clock())], "batch_id long, now timestamp")
    notes.merge(made, n)
    return made.head()["now"]


def read_clock(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, now): the time each micro-batch was given."""
    return read_upserts(spark, f"{path}/clock", ["batch_id"])


def read_window_means(spark: SparkSession, path: str) -> DataFrame:
    """Mean and latest event time per sensor and window, as ``sliding_mean`` gives them."""
    return means_of_totals(read_upserts(spark, f"{path}/totals", ["sensor_id", "window_start", "window_end"]))


def split_late_in_batches(
    records: DataFrame, path: str, checkpoint: str, delay: str = WATERMARK_DELAY, size: str | None = None,
    slide: str | None = None, rows_per_slice: int = ROWS_PER_SLICE, drain: bool = False,
) -> StreamingQuery:
    """``mark_late`` of a stream: records in time go to one table, late ones to another.

    Decided per record in order of arrival; the latest event time so far is carried between micro-batches.
    Read them with :func:`read_on_time` and :func:`read_late`.
    """

    def act(batch: DataFrame, n: int) -> None:
        seen = KeyedTable(batch.sparkSession, f"{path}/seen", ("one",), 1)
        rows = batch.persist()
        try:
            before = seen.read_before(n)
            known = before.head()["ts"] if before is not None else None
            marked = mark_late(rows, delay, size, slide, known, rows_per_slice).persist()
            _write_batch(marked.where("NOT late").drop("late"), f"{path}/on_time", n)
            _write_batch(marked.where("late").drop("late"), f"{path}/late", n)
            marked.unpersist()
            latest = rows.agg(F.max("ts").alias("ts")).select(F.lit(0).alias("one"), "ts")
            seen.merge(latest, n, lambda names: {name: F.max(name) for name in names})
        finally:
            rows.unpersist()

    return _each_batch(records, "append", act, checkpoint, drain)


def read_on_time(spark: SparkSession, path: str) -> DataFrame:
    return _read_results(spark, f"{path}/on_time")


def read_late(spark: SparkSession, path: str) -> DataFrame:
    return _read_results(spark, f"{path}/late")
