"""The shared test tables seen as the record types of this package.

``events`` stands in for every stream: a user is a sensor, the event type is the valve state, even event
numbers are primary readings and odd ones secondary readings or valve states, ten users make a vehicle.
``customer`` stands in for the owners, ``supplier`` for the sensor positions, ``documents`` for text.
Each function scans only the columns it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlens.functions import whole
from fleetlens.schemas import (
    BROKEN_DOWN, CELSIUS, CLOSE, DISSATISFIED, OBSTRUCTED, OPEN, PRIMARY, SATISFIED, SECONDARY,
)

SENSORS_PER_TEST_VEHICLE = 10


def _even() -> Column:
    return F.col("event_id") % 2 == 0


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """The raw events, with ``ts`` as TIMESTAMP; as a stream the file is matched by a pattern."""
    if stream:
        schema = table(spark, folder, "events").schema
        raw = spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet")
    else:
        raw = table(spark, folder, "events")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _state() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind.isin("view", "click"), OPEN).when(kind.isin("signup", "purchase"), CLOSE).otherwise(OBSTRUCTED)
    )


def as_measurements(raw: DataFrame) -> DataFrame:
    return raw.select(
        "ts", F.col("user_id").alias("sensor_id"), F.lit(CELSIUS).alias("units"), "value",
        F.col("event_id").alias("seq"))


def as_valve_states(raw: DataFrame) -> DataFrame:
    return raw.select(
        "ts", F.col("user_id").alias("sensor_id"), _state().alias("state"), F.col("event_id").alias("seq"))


def primary(raw: DataFrame) -> DataFrame:
    return as_measurements(raw.where(_even()))


def secondary(raw: DataFrame) -> DataFrame:
    return as_measurements(raw.where(~_even()))


def valve_states(raw: DataFrame) -> DataFrame:
    return as_valve_states(raw.where(~_even()))


def as_tagged(raw: DataFrame) -> DataFrame:
    """Primary and secondary readings from one scan."""
    return as_measurements(raw).select(
        F.when(F.col("seq") % 2 == 0, PRIMARY).otherwise(SECONDARY).alias("type"), "*")


def as_stacked(raw: DataFrame) -> DataFrame:
    """Primary readings and valve states from one scan, NULL in the other side's column."""
    return raw.select(
        "ts", F.col("user_id").alias("sensor_id"), F.when(_even(), F.col("value")).alias("value"),
        F.when(~_even(), _state()).alias("state"))


def as_observed(raw: DataFrame) -> DataFrame:
    """Every event as a reading together with a valve state."""
    return raw.select(
        "ts", F.col("user_id").alias("sensor_id"), "value", _state().alias("state"),
        F.col("event_id").alias("seq"))


def as_reports(raw: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return raw.select(
        "ts", whole(F.col("user_id"), SENSORS_PER_TEST_VEHICLE).alias("vehicle_id"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("customer_name"),
        F.when(kind == "error", BROKEN_DOWN).when(kind == "signup", DISSATISFIED)
        .otherwise(SATISFIED).alias("value"),
        F.col("event_id").alias("seq"))


def as_edits(raw: DataFrame) -> DataFrame:
    return raw.select(
        "ts", F.col("user_id").cast("string").alias("user"),
        F.floor("value").cast("long").alias("byte_diff"), F.col("event_id").alias("seq"))


def as_tied(measurements: DataFrame) -> DataFrame:
    """The same readings in steps of 50, so that equal values occur."""
    return measurements.withColumn("value", F.floor(F.col("value") / 50).cast("double"))


def span(raw: DataFrame) -> tuple[int, int]:
    """The first event number and how many there are room for; (0, 1) without events."""
    first, last = raw.agg(F.min("event_id"), F.max("event_id")).first()
    return (0, 1) if first is None else (first, last - first + 1)


def arriving_backwards(measurements: DataFrame, first: int, room: int, blocks: int = 9) -> DataFrame:
    """The same readings, each of ``blocks`` parts of the stream arriving last record first, so that some are late."""
    place = F.col("seq") - first
    block = whole(place * blocks, room)
    start, after = (whole((block + k) * room + (blocks - 1), blocks) for k in range(2))
    return measurements.withColumn("seq", first + start + after - 1 - place)


def owners(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("vehicle_id"), F.col("c_name").alias("owner_name"),
        (F.col("c_custkey") % 5 == 0).alias("reported_stolen"))
