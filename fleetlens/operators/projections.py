"""Row-wise analyses: no shuffle, whole-stage code generation, filters reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetlens.functions import fahrenheit, vehicle_of
from fleetlens.schemas import (
    FAHRENHEIT, LEVEL_TEMPERATURE, MEASUREMENT, PRIMARY, SECONDARY, SENSORS_PER_VEHICLE, VALVE_STATE, expect,
)


def to_fahrenheit(measurements: DataFrame) -> DataFrame:
    """Readings in Fahrenheit; every other field is kept."""
    expect(measurements, MEASUREMENT, "units", "value")
    return measurements.withColumns({"value": fahrenheit("value"), "units": F.lit(FAHRENHEIT)})


def fahrenheit_and_celsius(measurements: DataFrame) -> DataFrame:
    """Each reading twice, as it came and in Fahrenheit, from one pass over the input."""
    expect(measurements, MEASUREMENT, "units", "value")
    as_is = F.struct(*measurements.columns)
    converted = as_is.withField("units", F.lit(FAHRENHEIT)).withField("value", fahrenheit("value"))
    return measurements.select(F.inline(F.array(as_is, converted)))


def heat_alerts(measurements: DataFrame, threshold: float = 550.0, level: int = LEVEL_TEMPERATURE) -> DataFrame:
    """Readings strictly above ``threshold`` as alerts."""
    expect(measurements, MEASUREMENT)
    hot = measurements.where((F.col("value") > threshold) & ~F.isnan("value"))
    return hot.select("ts", "sensor_id", "units", "value", F.lit(level).alias("level"), "seq")


def tag_readings(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Both sensors' readings as one bag of ``TAGGED_READING``; duplicates are kept."""
    sides = [
        expect(df, MEASUREMENT).select(F.lit(tag).alias("type"), *MEASUREMENT.names)
        for df, tag in ((primary, PRIMARY), (secondary, SECONDARY))
    ]
    return sides[0].unionByName(sides[1])


def vehicle_activity(
    measurements: DataFrame, valve_states: DataFrame, sensors_per_vehicle: int = SENSORS_PER_VEHICLE
) -> DataFrame:
    """Any reading of either kind says its vehicle is in use."""
    expect(measurements, MEASUREMENT, "ts", "sensor_id")
    expect(valve_states, VALVE_STATE, "ts", "sensor_id")
    sides = [
        df.select(vehicle_of("sensor_id", sensors_per_vehicle).alias("vehicle_id"),
                  F.lit(1).alias("moving"), "ts")
        for df in (measurements, valve_states)
    ]
    return sides[0].unionByName(sides[1])


def only_sensor(df: DataFrame, sensor_id: int | None) -> DataFrame:
    """Keep one sensor; put after an aggregation it still reaches the scan, because it filters the key."""
    return df if sensor_id is None else df.where(F.col("sensor_id") == sensor_id)
