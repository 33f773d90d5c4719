"""Running the analyses on streams: sinks, side outputs, ordered analyses per micro-batch, closing records."""

from fleetlens.streaming.batches import (
    match_causes_in_batches, match_complaints_with_patterns, match_complaints_with_readings, match_patterns_in_batches,
    match_patterns_of_readings, read_causes, read_causes_state, read_pattern_alerts,
)
from fleetlens.streaming.closing import open_closing, with_closing, write_closing
from fleetlens.streaming.keyed import KeyedTable, read_upserts, write_upserts
from fleetlens.streaming.operator_state import (
    lookup_state, read_aggregate_state, read_latest_state, read_running_means_state, read_state, read_waiting,
    state_operators,
)
from fleetlens.streaming.processors import causes_by_keyed_state, read_processor_state
from fleetlens.streaming.running import (
    changelog_in_batches, read_changelog, read_clock, read_late, read_on_time, read_running_means, read_window_means,
    read_winners, running_mean_in_batches, split_late_in_batches, window_totals_in_batches,
)
from fleetlens.streaming.sinks import (
    append_latest, compact_latest, print_stream, print_table, read_current, read_latest, write_append,
    write_routed, write_updates,
)

__all__ = [
    "KeyedTable", "append_latest", "causes_by_keyed_state", "changelog_in_batches", "compact_latest", "lookup_state", "match_causes_in_batches",
    "match_complaints_with_patterns", "match_complaints_with_readings", "match_patterns_in_batches",
    "match_patterns_of_readings", "open_closing", "print_stream", "print_table",
    "read_aggregate_state", "read_causes", "read_causes_state", "read_changelog", "read_clock", "read_current",
    "read_late", "read_latest", "read_latest_state", "read_on_time", "read_pattern_alerts", "read_processor_state", "read_running_means",
    "read_running_means_state", "read_state", "read_upserts", "read_waiting", "read_window_means", "read_winners",
    "running_mean_in_batches", "split_late_in_batches", "state_operators", "window_totals_in_batches", "with_closing",
    "write_append", "write_closing", "write_routed", "write_updates", "write_upserts",
]
