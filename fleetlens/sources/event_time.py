"""Event time and processing time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.schemas import WATERMARK_DELAY


def from_epoch_millis(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Replace an epoch-millisecond column by ``ts TIMESTAMP``."""
    return df.withColumn("ts", F.timestamp_millis(F.col(column))).drop(column)


def with_event_time(df: DataFrame, delay: str = WATERMARK_DELAY, column: str = "ts") -> DataFrame:
    """Bounded-disorder watermark: a window closes once an event ``delay`` past its end was seen.

    After a union set it on the union, once.  Two watermarked inputs of a join advance together by the
    slower one.  On a table it does nothing.
    """
    return df.withWatermark(column, delay) if df.isStreaming else df


def with_processing_time(df: DataFrame, column: str = "pt", clock: Column | None = None) -> DataFrame:
    """Add the time at which Spark processes the record (one value per micro-batch)."""
    stamped = df.withColumn(column, F.current_timestamp() if clock is None else clock)
    return with_event_time(stamped, "0 seconds", column)
