"""Readers: one explicit schema per record type, the same call for a table and for a file stream.

``stream=True`` reads new files of the directory as they appear; ``max_files_per_trigger`` bounds a
micro-batch.  Offsets live in the query's checkpoint, so a restart neither loses nor repeats files.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession, types as T

from fleetlens import schemas


def from_elements(spark: SparkSession, rows: Iterable[Any], schema: T.StructType | T.DataType) -> DataFrame:
    """A small table from literal records."""
    return spark.createDataFrame(list(rows), schema)


def load_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    stream: bool = False,
    max_files_per_trigger: int | None = None,
    **options: Any,
) -> DataFrame:
    """Read ``path`` (parquet, orc, json, csv or text) as ``schema``, as a table or as a stream."""
    reader = (spark.readStream if stream else spark.read).format(fmt).options(**options)
    if stream and max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt != "text":
        reader = reader.schema(schema)
    return reader.load(path)


def load_measurements(spark: SparkSession, path: str, **kw: Any) -> DataFrame:
    """Temperature readings, primary or secondary sensor."""
    return load_records(spark, path, schemas.MEASUREMENT, **kw)


def load_valve_states(spark: SparkSession, path: str, **kw: Any) -> DataFrame:
    return load_records(spark, path, schemas.VALVE_STATE, **kw)


def load_customer_reports(spark: SparkSession, path: str, **kw: Any) -> DataFrame:
    return load_records(spark, path, schemas.CUSTOMER_REPORT, **kw)


def load_alerts(spark: SparkSession, path: str, **kw: Any) -> DataFrame:
    """Sensor alerts that another job wrote."""
    return load_records(spark, path, schemas.SENSOR_ALERT, **kw)


def load_edits(spark: SparkSession, path: str, **kw: Any) -> DataFrame:
    return load_records(spark, path, schemas.EDIT, **kw)


def load_text_lines(spark: SparkSession, path: str, **kw: Any) -> DataFrame:
    """One row per line of the text files, in column ``value``."""
    return load_records(spark, path, schemas.TEXT_LINE, **{"fmt": "text", **kw})


def load_owners(spark: SparkSession, path: str, **kw: Any) -> DataFrame:
    """Owner dimension: a bounded table, read once per query and joined, never called per record."""
    return load_records(spark, path, schemas.OWNER, **kw)


def load_sensor_reference(spark: SparkSession, path: str, **kw: Any) -> DataFrame:
    return load_records(spark, path, schemas.SENSOR_REFERENCE, **kw)
