"""Unwindowed aggregation per sensor.

``latest_observation`` and ``max_reading`` give the final value (on a stream: ``update`` mode, one row
per changed sensor and micro-batch).  ``reading_changelog`` and ``running_mean`` give one row per input
record and are for tables; they scan in order of arrival with :func:`fleetlens.plans.ordered_scan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.operators.projections import only_sensor
from fleetlens.plans import Slices, ordered_scan
from fleetlens.plans.slices import ROWS_PER_SLICE
from fleetlens.schemas import MEASUREMENT, expect

_RECORD = MEASUREMENT.names
_UPTO = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)
_FIRST = -(1 << 63)  # place of what is known before all records; arrival numbers are above


def _rank(rule: str) -> list[Column]:
    """What to maximise: the record with the greatest rank wins."""
    if rule == "latest":
        return [F.col("ts"), -F.col("seq")]
    # NaN is no reading: it ranks with NULL, below every number.
    value = F.nanvl("value", F.lit(None).cast("double"))
    if rule == "max_last":
        return [value, F.col("seq")]
    if rule == "max_first":
        return [value, -F.col("seq")]
    raise ValueError(f"unknown rule {rule!r}")


def _ranked(rule: str) -> Column:
    rank = [c.alias(f"_r{i}") for i, c in enumerate(_rank(rule))]
    return F.struct(*rank, *_RECORD)


def _winner(measurements: DataFrame, rule: str, sensor_id: int | None) -> DataFrame:
    expect(measurements, MEASUREMENT)
    best = measurements.groupBy("sensor_id").agg(F.max(_ranked(rule)).alias("_best"))
    return only_sensor(best, sensor_id).select(*[F.col(f"_best.{n}").alias(n) for n in _RECORD])


def latest_observation(measurements: DataFrame, sensor_id: int | None = None) -> DataFrame:
    """The whole record with the latest event time per sensor; the first to arrive wins a tie."""
    return _winner(measurements, "latest", sensor_id)


def max_reading(measurements: DataFrame, tie: str = "last", sensor_id: int | None = None) -> DataFrame:
    """The whole record with the highest value per sensor; ``tie`` keeps the ``first`` or ``last`` one."""
    return _winner(measurements, f"max_{tie}", sensor_id)


def winners(measurements: DataFrame, rule: str) -> DataFrame:
    """The whole winning record per sensor under ``rule``."""
    return _winner(measurements, rule, None)


def reading_changelog(
    measurements: DataFrame,
    rule: str = "max_last",
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """One row per record: the winner so far under ``rule`` (``latest``, ``max_last`` or ``max_first``).

    ``at_seq`` is the record that caused the row.
    """
    return best_so_far(measurements, None, rule, rows_per_slice, slices)


def best_so_far(
    measurements: DataFrame, known: DataFrame | None, rule: str, rows_per_slice: int = ROWS_PER_SLICE,
    slices: Slices | None = None,
) -> DataFrame:
    """:func:`reading_changelog` of records that arrive after the ``known`` winners, at most one per sensor."""
    expect(measurements, MEASUREMENT)
    best = _ranked(rule)
    kind = measurements.select(best.alias("best")).schema["best"].dataType.simpleString()
    rows = measurements.withColumn("_at", F.col("seq"))
    if known is not None:
        rows = rows.unionByName(known.withColumn("_at", F.lit(_FIRST)))
    scanned = ordered_scan(
        rows, ["sensor_id"], ["_at"],
        local=lambda w: [{"_run": F.max(best).over(w.rowsBetween(*_UPTO))}],
        totals={"_top": F.max(best)},
        inherit=lambda w: [{"_prior": F.max("_top").over(w.rowsBetween(*_BEFORE))}],
        inherited=f"_prior {kind}",
        slices=slices, rows_per_slice=rows_per_slice,
    )
    if known is not None:
        scanned = scanned.where(F.col("_at") != _FIRST)
    return (
        scanned.select(F.col("_at").alias("at_seq"), F.greatest("_run", "_prior").alias("_best"))
        .select("at_seq", *[F.col(f"_best.{n}").alias(n) for n in _RECORD])
    )


def running_mean(
    measurements: DataFrame,
    every: int = 1,
    compat: bool = False,
    sensor_id: int | None = None,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Mean of all readings so far and the latest event time, at every ``every``-th record.

    Per sensor by default.  ``compat=True`` takes one mean over all sensors together, as the windows of
    the original exercise literally do, and labels it with the sensor that reported last.
    On a stream the result is one row per changed sensor and micro-batch (``update`` mode); for a row per
    record there see :func:`fleetlens.streaming.running_mean_in_batches`.
    """
    expect(measurements, MEASUREMENT)
    if measurements.isStreaming:
        if compat or every != 1:
            raise ValueError("a stream reports once per micro-batch; compat and every are for tables")
        grouped = measurements.groupBy("sensor_id").agg(F.max("ts").alias("ts"), F.avg("value").alias("mean"))
        return only_sensor(grouped, sensor_id)

    source = measurements.select("ts", "sensor_id", "value", "seq")
    if not compat:
        source = only_sensor(source, sensor_id)
    return only_sensor(mean_so_far(source, None, every, compat, rows_per_slice, slices), sensor_id)


def mean_totals(measurements: DataFrame) -> DataFrame:
    """What a running mean carries per sensor: the sum and number of values and the latest event time."""
    return measurements.groupBy("sensor_id").agg(
        F.sum("value").alias("total"), F.count("value").alias("n"), F.max("ts").alias("ts"))


def add_totals(names: list[str]) -> dict[str, Column]:
    """Aggregates that add up rows of such totals."""
    return {name: F.max(name) if name == "ts" else F.sum(name) for name in names}


def mean_so_far(
    measurements: DataFrame, known: DataFrame | None, every: int = 1, compat: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE, slices: Slices | None = None,
) -> DataFrame:
    """:func:`running_mean` of records that arrive after those added up in ``known`` (rows of ``mean_totals``)."""
    rows = measurements.select("seq", "sensor_id", "ts", F.col("value").alias("_add"),
                               F.when(F.col("value").isNotNull(), 1).otherwise(0).cast("long").alias("_one"))
    if known is not None:
        rows = rows.unionByName(known.select(
            F.lit(_FIRST).alias("seq"), "sensor_id", "ts", F.col("total").alias("_add"), F.col("n").alias("_one")))
    scanned = ordered_scan(
        rows, [] if compat else ["sensor_id"], ["seq"],
        local=lambda w: [{
            "_sum": F.sum("_add").over(w.rowsBetween(*_UPTO)),
            "_n": F.sum("_one").over(w.rowsBetween(*_UPTO)),
            "_last": F.max("ts").over(w.rowsBetween(*_UPTO)),
        }],
        totals={"_tsum": F.sum("_add"), "_tn": F.sum("_one"), "_tlast": F.max("ts")},
        inherit=lambda w: [{
            "_psum": F.sum("_tsum").over(w.rowsBetween(*_BEFORE)),
            "_pn": F.sum("_tn").over(w.rowsBetween(*_BEFORE)),
            "_plast": F.max("_tlast").over(w.rowsBetween(*_BEFORE)),
        }],
        inherited="_psum double, _pn long, _plast timestamp",
        slices=slices, rows_per_slice=rows_per_slice,
    )
    count = F.col("_n") + F.coalesce("_pn", F.lit(0))
    total = F.coalesce("_sum", F.lit(0.0)) + F.coalesce("_psum", F.lit(0.0))
    result = scanned.where(count % every == 0) if every != 1 else scanned
    if known is not None:
        result = result.where(F.col("seq") != _FIRST)
    return result.select("seq", "sensor_id", F.greatest("_last", "_plast").alias("ts"),
                         F.when(count > 0, total / count).alias("mean"))
