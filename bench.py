"""Time the registered queries on the shared test tables and print one JSON line.

Each query runs twice into a sink that discards the rows; the second run counts, so that one-time code
generation does not.  BENCH_SF_DIR and BENCH_CPUS choose the tables and the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from fleetlens.catalog import QUERIES, STREAM_QUERIES
from fleetlens.plans import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
HEADLINE = [
    "word_count", "to_fahrenheit", "fahrenheit_and_celsius", "heat_alerts", "latest_observation",
    "max_reading_last", "max_reading_first", "running_mean", "running_mean_all_sensors",
    "max_changelog_last", "sliding_mean", "sensor_deviation", "sensor_deviation_compat", "valve_performance",
    "state_at_reading", "state_alerts", "vehicle_activity", "with_owner", "stolen_vehicles", "dangerous_valves",
    "potential_causes", "potential_causes_sql",
    "latest_per_vehicle", "edit_bytes_per_user", "customer_service",
    "stream_sliding_mean", "stream_state_at_reading", "stream_dangerous_valves", "stream_potential_causes",
    "stream_customer_service", "late_records", "dangerous_valves_compat", "stream_running_mean_every_third",
    "stream_max_changelog_last", "stream_operator_state", "stream_causes_by_keyed_state",
]


def main() -> None:
    spark = build_session("fleetlens-bench", f"local[{CPUS}]", CPUS, {
        "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    known = {**QUERIES, **STREAM_QUERIES}
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            known[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 4)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
