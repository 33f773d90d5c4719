"""Loading tables and streams with explicit schemas."""

from fleetlens.sources.load import (
    from_elements, load_alerts, load_customer_reports, load_edits, load_measurements, load_owners,
    load_records, load_sensor_reference, load_text_lines, load_valve_states,
)
from fleetlens.sources.event_time import from_epoch_millis, with_event_time, with_processing_time

__all__ = [
    "from_elements", "from_epoch_millis", "load_alerts", "load_customer_reports", "load_edits", "load_measurements",
    "load_owners", "load_records", "load_sensor_reference", "load_text_lines", "load_valve_states",
    "with_event_time", "with_processing_time",
]
