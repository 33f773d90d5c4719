"""The analyses: DataFrame-to-DataFrame functions, on tables and (where Spark allows) on streams."""

from fleetlens.operators.causes import (
    latest_per_vehicle, lookup, potential_causes, stack_reports_and_alerts,
)
from fleetlens.operators.enrichment import stolen_vehicles, with_owner, with_sensor_reference
from fleetlens.operators.joins import (
    route_alerts, state_alerts, state_at_reading, tag_alerts, temperature_and_obstruction_alerts,
)
from fleetlens.operators.lateness import mark_late
from fleetlens.operators.patterns import dangerous_valves
from fleetlens.operators.projections import (
    fahrenheit_and_celsius, heat_alerts, only_sensor, tag_readings, to_fahrenheit, vehicle_activity,
)
from fleetlens.operators.rolling import latest_observation, max_reading, reading_changelog, running_mean
from fleetlens.operators.tables import (
    POTENTIAL_CAUSES_SQL, potential_causes_sql, publish_alerts, publish_reports,
)
from fleetlens.operators.windows import (
    edit_bytes_per_user, means_of_totals, sensor_deviation, sliding_mean, stack_observations, valve_performance,
    window_totals,
)
from fleetlens.operators.words import running_word_count, word_count, word_count_changelog

__all__ = [
    "POTENTIAL_CAUSES_SQL", "dangerous_valves", "edit_bytes_per_user", "fahrenheit_and_celsius",
    "heat_alerts", "latest_observation", "latest_per_vehicle", "lookup", "mark_late", "max_reading", "means_of_totals", "only_sensor",
    "potential_causes", "potential_causes_sql", "publish_alerts", "publish_reports", "reading_changelog",
    "route_alerts", "running_mean", "running_word_count", "sensor_deviation", "sliding_mean",
    "stack_observations", "stack_reports_and_alerts", "state_alerts", "state_at_reading",
    "stolen_vehicles", "tag_alerts", "tag_readings", "temperature_and_obstruction_alerts",
    "to_fahrenheit", "valve_performance", "vehicle_activity", "window_totals", "with_owner", "with_sensor_reference",
    "word_count", "word_count_changelog",
]
