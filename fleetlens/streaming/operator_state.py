"""The live state of a running query, read from outside as a table.

A stateful query keeps its state in its checkpoint, one version per micro-batch.  These functions read it with
Spark's state data source: nothing has to be written by the query for it, and the query need not stop.  A read
sees the whole state at the end of a chosen micro-batch (by default the newest that was committed) and is spread
over the state's partitions.  Old versions can be read as far as the query keeps them
(``spark.sql.streaming.minBatchesToRetain``).
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

_COMPLAINT, _ALERT = "complaint", "alert"


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per stateful operator and store of a query, with the micro-batches that can be read."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        F.col("operatorId").alias("operator_id"), F.col("operatorName").alias("operator_name"),
        F.col("stateStoreName").alias("store"), F.col("numPartitions").alias("partitions"),
        F.col("minBatchId").alias("first_batch"), F.col("maxBatchId").alias("last_batch"))


def read_state(
    spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None, side: str | None = None,
) -> DataFrame:
    """(partition_id, key STRUCT, value STRUCT) of one operator after micro-batch ``batch``.

    ``side`` is ``left`` or ``right`` for a join of two streams, whose state are the rows that still wait.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    if side is not None:
        reader = reader.option("joinSide", side)
    return reader.load(checkpoint)


def read_aggregate_state(
    spark: SparkSession, checkpoint: str, buffers: list[str], operator: int = 0, batch: int | None = None,
) -> DataFrame:
    """Keys and buffers of a running aggregate; ``buffers`` names the buffers' fields in their order.

    A buffer has one field for a sum, a count or a maximum, two for a mean (sum, count) and for ``max_by`` (the
    value, what it is ordered by).
    """
    state = read_state(spark, checkpoint, operator, batch)
    fields = state.schema["value"].dataType.fields
    if len(fields) != len(buffers):
        raise ValueError(f"the state has {len(fields)} fields, not {len(buffers)}")
    named = StructType([StructField(name, field.dataType) for name, field in zip(buffers, fields)])
    return state.select("key.*", F.col("value").cast(named).alias("_value")).select(
        *state.schema["key"].dataType.names, "_value.*")


def read_running_means_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(sensor_id, ts, mean) of a running ``running_mean`` after a micro-batch."""
    state = read_aggregate_state(spark, checkpoint, ["ts", "total", "n"], batch=batch)
    return state.select("sensor_id", "ts", F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("mean"))


def read_latest_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(vehicle_id, complaint, alert) of a running ``latest_per_vehicle`` after a micro-batch."""
    state = read_aggregate_state(
        spark, checkpoint, [_COMPLAINT, "complaint_order", _ALERT, "alert_order"], batch=batch)
    return state.select("vehicle_id", _COMPLAINT, _ALERT)


def lookup_state(
    spark: SparkSession, checkpoint: str, vehicle_id: int, what: str, batch: int | None = None,
) -> Row | None:
    """The last ``complaint`` or ``alert`` of one vehicle, asked of the running query's state."""
    if what not in (_COMPLAINT, _ALERT):
        raise ValueError(f"what is 'complaint' or 'alert', not {what!r}")
    found: list[Any] = read_latest_state(spark, checkpoint, batch).where(
        F.col("vehicle_id") == vehicle_id).select(what).take(1)
    return found[0][0] if found else None


def read_waiting(spark: SparkSession, checkpoint: str, side: str, batch: int | None = None) -> DataFrame:
    """The rows of one side of a stream join that still wait for a partner."""
    state = read_state(spark, checkpoint, 0, batch, side)
    keys = {f"key_{name}": F.col(f"key.`{name}`") for name in state.schema["key"].dataType.names}
    values: list[Column] = [F.col(f"value.`{name}`") for name in state.schema["value"].dataType.names
                            if name != "matched"]
    return state.select(*[c.alias(name) for name, c in keys.items()], *values)
