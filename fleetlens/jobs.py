"""The composed analyses: whole jobs from raw records to result.

Every other job is a single operator and is called directly.  All of them take tables; those marked
(stream) also take streams.  Intermediate results that a later step reads more than once are settled
first, i.e. checkpointed in the cluster's shared folder.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from fleetlens import operators as ops
from fleetlens.plans import settle
from fleetlens.schemas import SENSORS_PER_VEHICLE
from fleetlens.sources import with_event_time
from fleetlens.streaming import match_causes_in_batches, match_complaints_with_readings, match_patterns_of_readings

# The pattern jobs pair a reading with states up to 200 ms before it, in windows of 2 s.
PATTERN_PAIRS = {"size": "2 seconds", "within": "200 milliseconds"}


def state_temperature_alerts(measurements: DataFrame, valve_states: DataFrame, compat: bool = False) -> DataFrame:
    """(stream) Temperature and obstruction alerts that take the valve state into account."""
    return ops.state_alerts(ops.state_at_reading(
        with_event_time(measurements), with_event_time(valve_states)), compat=compat)


def redundant_sensor_alerts(primary: DataFrame, secondary: DataFrame, compat: bool = False) -> DataFrame:
    """(stream) Alerts where two sensors of a valve disagree."""
    return ops.sensor_deviation(with_event_time(ops.tag_readings(primary, secondary)), compat=compat)


def mean_performance(measurements: DataFrame, valve_states: DataFrame) -> DataFrame:
    """(stream) State shares and mean temperature per valve."""
    return ops.valve_performance(with_event_time(ops.stack_observations(measurements, valve_states)))


def stolen_vehicle_activity(
    measurements: DataFrame, valve_states: DataFrame, owners: DataFrame,
    sensors_per_vehicle: int = SENSORS_PER_VEHICLE,
) -> DataFrame:
    """(stream) Activity of the vehicles whose owner reported them stolen."""
    activity = ops.vehicle_activity(measurements, valve_states, sensors_per_vehicle)
    return ops.stolen_vehicles(ops.with_owner(activity, owners))


def _paired(measurements: DataFrame, valve_states: DataFrame, pairs: dict[str, str] | None) -> DataFrame:
    """Readings with the valve states before them, with the columns that the pattern looks at."""
    paired = ops.state_at_reading(
        with_event_time(measurements), with_event_time(valve_states), **(pairs or PATTERN_PAIRS))
    return paired.select("ts", "sensor_id", "value", "state", "seq", "state_seq")


def pattern_alerts(
    measurements: DataFrame, valve_states: DataFrame, pairs: dict[str, str] | None = None,
    pattern: dict[str, Any] | None = None,
) -> DataFrame:
    """Level 5 alerts of valves that stop opening and then heat up."""
    return ops.dangerous_valves(settle(_paired(measurements, valve_states, pairs)), **(pattern or {}))


def pattern_alerts_stream(
    measurements: DataFrame, valve_states: DataFrame, path: str, checkpoint: str, drain: bool = False,
    pairs: dict[str, str] | None = None, pattern: dict[str, Any] | None = None,
) -> StreamingQuery:
    """(stream) The same into tables below ``path``."""
    return match_patterns_of_readings(
        measurements, valve_states, path, checkpoint, pairs or PATTERN_PAIRS, drain=drain, **(pattern or {}))


def customer_service(
    reports: DataFrame, measurements: DataFrame, valve_states: DataFrame, within: str = "2 hours",
    sensors_per_vehicle: int = SENSORS_PER_VEHICLE, pairs: dict[str, str] | None = None,
    pattern: dict[str, Any] | None = None,
) -> DataFrame:
    """Complaints matched with the pattern alerts of their vehicle, by last-seen state."""
    alerts = settle(pattern_alerts(measurements, valve_states, pairs, pattern))
    return ops.potential_causes(reports, alerts, within, sensors_per_vehicle)


def customer_service_stream(
    reports: DataFrame, measurements: DataFrame, valve_states: DataFrame, path: str, checkpoint: str,
    drain: bool = False, within: str = "2 hours", sensors_per_vehicle: int = SENSORS_PER_VEHICLE,
    pairs: dict[str, str] | None = None, pattern: dict[str, Any] | None = None,
) -> StreamingQuery:
    """(stream) The whole chain as one query; pairs, alerts and state per vehicle are tables below ``path``."""
    return match_complaints_with_readings(
        reports, measurements, valve_states, path, checkpoint, pairs or PATTERN_PAIRS, within, sensors_per_vehicle,
        drain=drain, **(pattern or {}))


def complaints_stream(
    reports: DataFrame, alerts: DataFrame, path: str, checkpoint: str, drain: bool = False,
) -> StreamingQuery:
    """(stream) Complaints matched with given alerts."""
    return match_causes_in_batches(reports, alerts, path, checkpoint, drain=drain)


def customer_service_sql(
    reports: DataFrame, measurements: DataFrame, valve_states: DataFrame, within: str = "1 hour"
) -> DataFrame:
    """Complaints with all pattern alerts of their vehicle in a band around them, in SQL."""
    ops.publish_reports(reports)
    ops.publish_alerts(settle(pattern_alerts(measurements, valve_states)))
    return ops.potential_causes_sql(reports.sparkSession, within)


def customer_service_lookup(
    reports: DataFrame, measurements: DataFrame, valve_states: DataFrame
) -> DataFrame:
    """The last complaint and last pattern alert per vehicle, for :func:`fleetlens.operators.lookup`."""
    return ops.latest_per_vehicle(reports, settle(pattern_alerts(measurements, valve_states)))
