"""Closing a drained stream.

In append mode a window comes out once the watermark has passed its end, so the last windows of a stream that
ends would never come out.  A stream that is to be closed reads one more folder, the closing folder.  When the
input is worked off, a record far in the future is written there and the query is drained once more: the
watermark passes all windows but those of that record.
"""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def open_closing(spark: SparkSession, schema: StructType, folder: str) -> None:
    """Make an empty closing folder."""
    spark.createDataFrame([], schema).coalesce(1).write.mode("ignore").parquet(folder)


def with_closing(stream: DataFrame, folder: str) -> DataFrame:
    """The stream and what is written to its closing folder; put the watermark behind it."""
    spark = stream.sparkSession
    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(folder))


def write_closing(spark: SparkSession, schema: StructType, folder: str, after: dt.datetime, **values: Any) -> None:
    """Write the closing record: column ``ts`` lies 1,000 days behind ``after``, the others as in ``values``."""
    row = {field.name: values.get(field.name) for field in schema.fields} | {"ts": after + dt.timedelta(days=1_000)}
    spark.createDataFrame([tuple(row[field.name] for field in schema.fields)], schema).coalesce(1).write.mode(
        "append").parquet(folder)
