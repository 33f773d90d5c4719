"""Windowed aggregation.  All of it is native partial + final aggregation: rows are reduced inside the
scan tasks, so a hot sensor or a crowded window sends one row per task through the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetlens.operators.projections import only_sensor
from fleetlens.schemas import (
    CLOSE, EDIT, LEVEL_TEMPERATURE, MEASUREMENT, OBSERVED_STATE, OBSTRUCTED, OPEN, PRIMARY, TAGGED_READING,
    UNITS_DEVIATION, VALVE_STATE, expect,
)


def sliding_mean(
    measurements: DataFrame,
    size: str = "10 seconds",
    slide: str = "5 seconds",
    time: str = "ts",
    sensor_id: int | None = None,
) -> DataFrame:
    """Mean value and latest event time per sensor and sliding window.

    ``time="ts"`` windows by event time; for processing time add a clock column with
    :func:`fleetlens.sources.with_processing_time` and name it here.
    """
    expect(measurements, MEASUREMENT, "ts", "sensor_id", "value")
    grouped = (
        measurements.groupBy("sensor_id", F.window(time, size, slide).alias("window"))
        .agg(F.max("ts").alias("ts"), F.avg("value").alias("mean"))
    )
    return only_sensor(grouped, sensor_id).select(
        "sensor_id", "ts", "mean",
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
    )


def window_totals(measurements: DataFrame, size: str = "10 seconds", slide: str = "5 seconds", time: str = "ts") -> DataFrame:
    """The parts of :func:`sliding_mean` that can be added up: sum, number of values and latest event time."""
    expect(measurements, MEASUREMENT, "ts", "sensor_id", "value")
    return measurements.groupBy("sensor_id", F.window(time, size, slide).alias("window")).agg(
        F.max("ts").alias("ts"), F.sum("value").alias("total"), F.count("value").alias("n")).select(
        "sensor_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "ts",
        "total", "n")


def means_of_totals(totals: DataFrame) -> DataFrame:
    """The rows of :func:`sliding_mean` from added-up totals."""
    return totals.select("sensor_id", "ts", F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("mean"),
                         "window_start", "window_end")


def sensor_deviation(
    tagged: DataFrame, size: str = "10 seconds", tolerance: float = 20.0, compat: bool = False
) -> DataFrame:
    """Alert where the primary and secondary means of a sensor differ by more than ``tolerance``.

    ``tagged`` is a bag of ``TAGGED_READING`` (see :func:`tag_readings`).  A window that lacks one side
    has no mean there and never alerts.  ``compat=True`` compares the mean of *all* readings with the
    secondary mean, as the pre-aggregating variant of the original exercise literally does.
    """
    expect(tagged, TAGGED_READING, "type", "ts", "sensor_id", "value")
    is_primary = F.col("type") == PRIMARY
    first = F.avg("value") if compat else F.avg(F.when(is_primary, F.col("value")))
    means = (
        tagged.groupBy("sensor_id", F.window("ts", size).alias("window"))
        .agg(first.alias("_first"), F.avg(F.when(~is_primary, F.col("value"))).alias("_second"))
        .withColumn("value", F.abs(F.col("_first") - F.col("_second")))
    )
    return means.where((F.col("value") > tolerance) & ~F.isnan("value")).select(
        F.col("window.end").alias("ts"), "sensor_id", F.lit(UNITS_DEVIATION).alias("units"), "value",
        F.lit(LEVEL_TEMPERATURE).alias("level"),
    )


def stack_observations(measurements: DataFrame, valve_states: DataFrame) -> DataFrame:
    """Readings and valve states as one bag; a row has NULL in the column of the other side."""
    expect(measurements, MEASUREMENT, "ts", "sensor_id", "value")
    expect(valve_states, VALVE_STATE, "ts", "sensor_id", "state")
    return measurements.select("ts", "sensor_id", "value", F.lit(None).cast("string").alias("state")).unionByName(
        valve_states.select("ts", "sensor_id", F.lit(None).cast("double").alias("value"), "state"))


def valve_performance(stacked: DataFrame, size: str = "25 seconds") -> DataFrame:
    """Share of each valve state and mean temperature per sensor and window that has both kinds of rows.

    ``stacked`` comes from :func:`stack_observations`; conditional aggregates over it replace a co-group
    that would buffer both sides of a group.
    """
    expect(stacked, OBSERVED_STATE, "ts", "sensor_id", "value", "state")
    grouped = (
        stacked.groupBy("sensor_id", F.window("ts", size).alias("window"))
        .agg(
            F.count("state").alias("_states"), F.count("value").alias("_values"),
            F.count_if(F.col("state") == OPEN).alias("_open"),
            F.count_if(F.col("state") == CLOSE).alias("_close"),
            F.count_if(F.col("state") == OBSTRUCTED).alias("_obstructed"),
            F.avg("value").alias("mean_temperature"),
        )
        .where((F.col("_states") > 0) & (F.col("_values") > 0))
    )
    return grouped.select(
        "sensor_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        (F.col("_open") / F.col("_states")).alias("pct_open"),
        (F.col("_close") / F.col("_states")).alias("pct_closed"),
        (F.col("_obstructed") / F.col("_states")).alias("pct_obstructed"),
        "mean_temperature",
    )


def edit_bytes_per_user(edits: DataFrame, size: str = "5 seconds", time: str = "ts") -> DataFrame:
    """Bytes changed per user and tumbling window."""
    expect(edits, EDIT, "ts", "user", "byte_diff")
    return (
        edits.groupBy("user", F.window(time, size).alias("window"))
        .agg(F.sum("byte_diff").alias("bytes"))
        .select("user", "bytes", F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"))
    )
