"""Readings joined with the valve state just before them, and the alerts made from those pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.functions import floor_div, interval_micros, micros
from fleetlens.schemas import (
    CLOSE, LEVEL_OBSTRUCTED, LEVEL_TEMPERATURE, MEASUREMENT, OBSTRUCTED, OPEN, UNITS_OBSTRUCTED,
    UNITS_TEMPERATURE, VALVE_STATE, expect,
)

OPEN_CLOSED_TAG, OBSTRUCTED_TAG = "open-closed", "obstructed"


def state_at_reading(
    measurements: DataFrame, valve_states: DataFrame,
    size: str = "200 milliseconds", within: str = "20 milliseconds",
) -> DataFrame:
    """Pairs of a reading and a valve state of the same sensor, in the same tumbling window of ``size``,
    the state strictly before the reading by strictly less than ``within``.

    Joined on (sensor, window, step of length ``within``).  A state is offered to its own step and the
    next one, a reading has one step, so each pair is found exactly once and the join looks at no pair
    further apart than two steps, however long the window and however busy the sensor.  On streams the
    time range lets Spark drop old state; both inputs need a watermark.
    """
    expect(measurements, MEASUREMENT)
    expect(valve_states, VALVE_STATE)
    span, reach = interval_micros(size), interval_micros(within)

    def window_of(ts: Column | str) -> Column:
        return floor_div(micros(ts), span)

    step = floor_div(micros("ts"), reach)
    last_step = floor_div((window_of("ts") + 1) * F.lit(span) - 1, reach)
    readings = measurements.select(
        "ts", "sensor_id", "units", "value", "seq",
        window_of("ts").alias("_win"), step.alias("_step"),
    )
    states = valve_states.select(
        F.col("ts").alias("state_ts"), F.col("sensor_id").alias("_sensor"), "state",
        F.col("seq").alias("state_seq"), window_of("ts").alias("_state_win"),
        F.explode(F.sequence(step, F.least(step + 1, last_step))).alias("_state_step"),
    )
    return readings.join(
        states,
        (F.col("sensor_id") == F.col("_sensor"))
        & (F.col("_win") == F.col("_state_win"))
        & (F.col("_step") == F.col("_state_step"))
        & (F.col("ts") > F.col("state_ts"))
        & (F.col("ts") < F.col("state_ts") + F.expr(f"INTERVAL {within}")),
    ).select("ts", "sensor_id", "units", "value", "seq", "state_ts", "state", "state_seq")


def tag_alerts(pairs: DataFrame, open_above: float = 500.0, closed_above: float = 550.0) -> DataFrame:
    """Pairs worth an alert, tagged ``open-closed`` (too hot for the state) or ``obstructed``."""
    state, value = F.col("state"), F.col("value")
    hot = ~F.isnan(value)
    worth = (
        ((value > open_above) & hot & (state == OPEN))
        | ((value > closed_above) & hot & (state == CLOSE))
        | (state == OBSTRUCTED)
    )
    return pairs.where(worth).withColumn(
        "tag", F.when(state == OBSTRUCTED, F.lit(OBSTRUCTED_TAG)).otherwise(F.lit(OPEN_CLOSED_TAG)))


def _as_alerts(tagged: DataFrame, units: str, level: int) -> DataFrame:
    return tagged.select("ts", "sensor_id", F.lit(units).alias("units"), "value",
                         F.lit(level).alias("level"), "seq", "state_seq")


def route_alerts(tagged: DataFrame, compat: bool = False) -> dict[str, DataFrame]:
    """The two alert tables: ``temperature`` (level 2) and ``obstructed`` (level 3).

    ``compat=True`` fills ``obstructed`` from the open-closed tag, as the original exercise literally
    does: its obstructed pairs are never reported.
    """
    hot = tagged.where(F.col("tag") == OPEN_CLOSED_TAG)
    blocked = hot if compat else tagged.where(F.col("tag") == OBSTRUCTED_TAG)
    return {
        "temperature": _as_alerts(hot, UNITS_TEMPERATURE, LEVEL_TEMPERATURE),
        "obstructed": _as_alerts(blocked, UNITS_OBSTRUCTED, LEVEL_OBSTRUCTED),
    }


def temperature_and_obstruction_alerts(tagged: DataFrame, compat: bool = False) -> DataFrame:
    """Both alert tables as one bag, from one pass over the tagged pairs."""
    hot = F.col("tag") == OPEN_CLOSED_TAG
    temperature = F.struct(F.lit(UNITS_TEMPERATURE).alias("units"), F.lit(LEVEL_TEMPERATURE).alias("level"))
    obstructed = F.struct(F.lit(UNITS_OBSTRUCTED).alias("units"), F.lit(LEVEL_OBSTRUCTED).alias("level"))
    if compat:
        kinds = F.when(hot, F.array(temperature, obstructed)).otherwise(F.array().cast(
            "array<struct<units:string,level:int>>"))
    else:
        kinds = F.array(F.when(hot, temperature).otherwise(obstructed))
    return tagged.select("ts", "sensor_id", "value", "seq", "state_seq", F.inline(kinds)).select(
        "ts", "sensor_id", "units", "value", "level", "seq", "state_seq")


def state_alerts(
    pairs: DataFrame, open_above: float = 500.0, closed_above: float = 550.0, compat: bool = False
) -> DataFrame:
    """Alerts that take the valve state into account; see :func:`route_alerts` for ``compat``."""
    return temperature_and_obstruction_alerts(tag_alerts(pairs, open_above, closed_above), compat)
