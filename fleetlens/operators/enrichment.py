"""Joins with reference tables.

No broadcast is forced: Spark broadcasts a dimension only while its measured size is below
``spark.sql.autoBroadcastJoinThreshold``.  A larger one is shuffled, and AQE splits the partitions of
hot vehicles on the activity side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetlens.schemas import MEASUREMENT, OWNER, SENSOR_REFERENCE, VEHICLE_STATE, expect


def with_owner(activity: DataFrame, owners: DataFrame) -> DataFrame:
    """Vehicle activity with its owner, as the structs ``state`` and ``owner``.

    A vehicle without an owner row keeps its activity; ``owner`` is NULL then.
    """
    expect(activity, VEHICLE_STATE)
    expect(owners, OWNER)
    dimension = owners.select(
        F.col("vehicle_id").alias("_vehicle"), F.struct("owner_name", "reported_stolen").alias("owner"))
    return activity.join(dimension, F.col("vehicle_id") == F.col("_vehicle"), "left").select(
        F.struct("vehicle_id", "moving", "ts").alias("state"), "owner")


def stolen_vehicles(enriched: DataFrame, view: str = "vehicles_moving") -> DataFrame:
    """Activity of vehicles reported stolen, read from the view it is published as.

    The filter concerns the owner side only, so Spark turns the left join into an inner one and filters
    the owners before joining.
    """
    enriched.createOrReplaceTempView(view)
    return (
        enriched.sparkSession.table(view)
        .where(F.col("owner.reported_stolen"))
        .select(F.col("state.vehicle_id").alias("vehicle_id"), F.col("state.ts").alias("ts"), "owner")
    )


def with_sensor_reference(measurements: DataFrame, sensors: DataFrame) -> DataFrame:
    """Readings with position and metadata of their sensor, as two structs."""
    expect(measurements, MEASUREMENT)
    expect(sensors, SENSOR_REFERENCE)
    dimension = sensors.select(
        F.col("sensor_id").alias("_sensor"), F.struct(*SENSOR_REFERENCE.names).alias("sensor_reference"))
    return measurements.join(dimension, F.col("sensor_id") == F.col("_sensor"), "left").select(
        F.struct(*MEASUREMENT.names).alias("measurement"), "sensor_reference")
