"""Scalar expressions of the data model."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetlens.schemas import COMPLAINTS, SENSORS_PER_VEHICLE


_UNIT_MICROS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000,
}


def _column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def whole(dividend: Column, divisor: int) -> Column:
    """Integer division of longs (``/`` would give a double)."""
    return F.call_function("div", dividend, F.lit(divisor).cast("long"))


def floor_div(dividend: Column, divisor: int) -> Column:
    """Integer division of longs rounded down, also before 1970."""
    return whole(dividend - F.pmod(dividend, F.lit(divisor)), divisor)


def interval_micros(text: str) -> int:
    """Microseconds of a fixed-length interval such as ``"200 milliseconds"`` or ``"1 hour"``."""
    amount, unit = text.split()
    unit = unit.lower().removesuffix("s")
    if unit not in _UNIT_MICROS:
        raise ValueError(f"not a fixed-length interval: {text!r}")
    return int(amount) * _UNIT_MICROS[unit]


def micros(ts: Column | str) -> Column:
    return F.unix_micros(_column(ts))


def fahrenheit(celsius: Column | str) -> Column:
    return _column(celsius) * F.lit(1.8) + F.lit(32.0)


def vehicle_of(sensor_id: Column | str, sensors_per_vehicle: int = SENSORS_PER_VEHICLE) -> Column:
    """Vehicle of a sensor: integer division, so sensor 199 belongs to vehicle 1."""
    return whole(_column(sensor_id), sensors_per_vehicle)


def split_words(text: Column | str) -> Column:
    """Lower-cased pieces of a text between non-word characters; may hold empty strings at the ends."""
    return F.split(F.lower(text), r"\W+")


def tokens(text: Column | str) -> Column:
    """Lower-cased words of a text as an array, without empty strings."""
    return F.array_remove(split_words(text), "")


def is_complaint(report_value: Column | str) -> Column:
    return _column(report_value).isin(*COMPLAINTS)
