from __future__ import annotations

import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fleetlens import schemas  # noqa: E402
from fleetlens.plans import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "fleetlens-tests", "local[4]", 4,
        {"spark.ui.enabled": "false", "spark.driver.memory": "4g",
         "spark.checkpoint.dir": tempfile.mkdtemp(prefix="fleetlens-checkpoint-"),
         "spark.sql.streaming.noDataMicroBatches.enabled": "true"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(ms: float) -> dt.datetime:
    """UTC instant ``ms`` milliseconds after the epoch."""
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(milliseconds=ms)


def ms_of(value: dt.datetime) -> float:
    """Inverse of :func:`at` for timestamps collected with session zone UTC."""
    if value.tzinfo is None:
        value = value.astimezone(dt.timezone.utc)
    return (value - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) / dt.timedelta(milliseconds=1)


class Tables:
    """Small tables; times are given in milliseconds, ``seq`` is the row number unless given."""

    def __init__(self, spark):
        self.spark = spark

    def measurements(self, *rows):
        """(ms, sensor, value[, seq])"""
        return self._make(schemas.MEASUREMENT, [
            (at(r[0]), r[1], "CELSIUS", float(r[2]), r[3] if len(r) > 3 else i) for i, r in enumerate(rows)])

    def tagged(self, *rows):
        """(type, ms, sensor, value)"""
        return self._make(schemas.TAGGED_READING, [
            (r[0], at(r[1]), r[2], "CELSIUS", float(r[3]), i) for i, r in enumerate(rows)])

    def states(self, *rows):
        """(ms, sensor, state)"""
        return self._make(schemas.VALVE_STATE, [(at(r[0]), r[1], r[2], i) for i, r in enumerate(rows)])

    def observed(self, *rows):
        """(ms, sensor, value, state[, seq])"""
        return self._make(schemas.OBSERVED_STATE, [
            (at(r[0]), r[1], float(r[2]), r[3], r[4] if len(r) > 4 else i) for i, r in enumerate(rows)])

    def reports(self, *rows):
        """(ms, vehicle, value[, seq])"""
        return self._make(schemas.CUSTOMER_REPORT, [
            (at(r[0]), r[1], f"owner {r[1]}", r[2], r[3] if len(r) > 3 else i) for i, r in enumerate(rows)])

    def alerts(self, *rows):
        """(ms, sensor, value[, seq])"""
        return self._make(schemas.SENSOR_ALERT, [
            (at(r[0]), r[1], "CELSIUS", float(r[2]), 2, r[3] if len(r) > 3 else i) for i, r in enumerate(rows)])

    def _make(self, schema, rows):
        return self.spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark)


def rows_of(df, *names):
    """Collected rows as sorted tuples, timestamps as milliseconds."""
    picked = df.select(*names) if names else df
    return sorted(
        (tuple(ms_of(v) if isinstance(v, dt.datetime) else v for v in row) for row in picked.collect()),
        key=lambda row: [(v is None, 0 if v is None else v) for v in row])
