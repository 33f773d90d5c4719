"""The stream forms of the analyses, replayed over the shared test tables.

Each query drains the input into a table below the shared checkpoint folder and returns that table.  In
append mode the input is then closed (:mod:`fleetlens.streaming.closing`), so the last windows are there too.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens import jobs, operators as ops, streaming
from fleetlens.catalog import sql
from fleetlens.catalog.queries import (
    FORCED_SLICE_ROWS, HOT, LATE_DELAY, LATE_WINDOW, PAIR_REACH, PAIR_WINDOW, VEHICLE, Query, rounded, finish,
)
from fleetlens.functions import whole
from fleetlens.plans.session import settings, shared_dir
from fleetlens.plans.slices import ROWS_PER_SLICE
from fleetlens.sources import shared_tables as tables, with_event_time, with_processing_time

STREAM_QUERIES: dict[str, Query] = {}
STREAM_SQL: dict[str, str] = {}

TURNS = 3
CLOCK_START = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
StreamQuery = Callable[[SparkSession, str, str, str], DataFrame]


def stream_query(twin: str) -> Callable[[StreamQuery], StreamQuery]:
    """Register ``fn(session, folder, table path, checkpoint path)``, which drains and reads back."""

    def register(fn: StreamQuery) -> StreamQuery:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            place = f"{shared_dir(spark)}/fleetlens/{fn.__name__}-{uuid.uuid4().hex}"
            session = spark.newSession()
            for key, value in {**settings(), "spark.sql.shuffle.partitions":
                               spark.conf.get("spark.sql.shuffle.partitions")}.items():
                session.conf.set(key, value)
            return finish(fn(session, folder, f"{place}/table", f"{place}/checkpoint"))

        run.__name__ = fn.__name__
        STREAM_QUERIES[fn.__name__] = run
        STREAM_SQL[fn.__name__] = twin
        return fn

    return register


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return tables.events(spark, folder, stream=True)


def _timed(spark: SparkSession, folder: str) -> DataFrame:
    return with_event_time(_events(spark, folder))


def _closed(spark: SparkSession, folder: str, path: str, start: Callable[[DataFrame], object],
            event_type: str = "view", value: float = 0.0) -> None:
    """Drain the events with ``start``, then close them; the closing records are of user -1."""
    events, closing = tables.events(spark, folder), f"{path}-closing"
    streaming.open_closing(spark, events.schema, closing)
    start(streaming.with_closing(_events(spark, folder), closing))
    last = events.agg(F.max("ts")).first()[0]
    for number in (-1, -2):  # one that passes for a primary reading, one for a secondary one
        streaming.write_closing(spark, events.schema, closing, last, event_id=number, user_id=-1,
                                event_type=event_type, value=value, props="")
    start(streaming.with_closing(_events(spark, folder), closing))


@stream_query(sql.SQL["heat_alerts"])
def stream_heat_alerts(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    alerts = ops.heat_alerts(tables.as_measurements(_events(spark, folder)), threshold=150.0)
    streaming.write_append(alerts, path, checkpoint, drain=True)
    return spark.read.parquet(path)


@stream_query(sql.SQL["word_count"])
def stream_word_count(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    schema = tables.table(spark, folder, "documents").schema
    lines = spark.readStream.schema(schema).parquet(f"{folder}/documents*.parquet")
    streaming.write_updates(ops.running_word_count(lines, "text"), path, checkpoint, drain=True)
    return streaming.read_current(spark, path, ["word"])


@stream_query(sql.SQL["latest_observation"])
def stream_latest_observation(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    latest = ops.latest_observation(tables.as_measurements(_events(spark, folder)))
    streaming.write_updates(latest, path, checkpoint, drain=True)
    return streaming.read_current(spark, path, ["sensor_id"])


@stream_query(sql.SQL["max_reading_first"])
def stream_max_reading_first(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    readings = tables.as_tied(tables.as_measurements(_events(spark, folder)))
    streaming.write_updates(ops.max_reading(readings, tie="first"), path, checkpoint, drain=True)
    return streaming.read_current(spark, path, ["sensor_id"])


@stream_query(
    f"SELECT user_id AS sensor_id, max(ts) AS ts, {sql._rounded('avg(value)')} AS mean FROM events GROUP BY user_id")
def stream_running_mean(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    means = ops.running_mean(tables.as_measurements(_events(spark, folder)))
    streaming.write_updates(means, path, checkpoint, drain=True)
    return streaming.read_current(spark, path, ["sensor_id"]).withColumns(rounded("mean"))


@stream_query(sql.SQL["sliding_mean"])
def stream_sliding_mean(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    def start(raw: DataFrame) -> None:
        means = ops.sliding_mean(tables.as_measurements(with_event_time(raw)), "2 days", "1 day")
        streaming.write_append(means, path, checkpoint, drain=True)

    _closed(spark, folder, path, start)
    return spark.read.parquet(path).withColumns(rounded("mean"))


@stream_query(
    f"SELECT sensor_id, ts, mean FROM ({STREAM_SQL['stream_running_mean']}) CROSS JOIN range(2)")
def stream_sliding_mean_processing_time(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    """One micro-batch has one processing time, so every sensor is in two overlapping windows."""
    clocked = with_processing_time(tables.as_measurements(_events(spark, folder)))
    means = ops.sliding_mean(clocked, "10 seconds", "5 seconds", time="pt")
    streaming.write_updates(means, path, checkpoint, drain=True)
    current = streaming.read_current(spark, path, ["sensor_id", "window_start", "window_end"])
    return current.select("sensor_id", "ts", "mean").withColumns(rounded("mean"))


@stream_query(sql.SQL["sensor_deviation"])
def stream_sensor_deviation(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    def start(raw: DataFrame) -> None:
        tagged = with_event_time(ops.tag_readings(tables.primary(raw), tables.secondary(raw)))
        streaming.write_append(ops.sensor_deviation(tagged, "3 days"), path, checkpoint, drain=True)

    _closed(spark, folder, path, start)
    return spark.read.parquet(path).withColumns(rounded("value"))


@stream_query(sql.SQL["valve_performance"])
def stream_valve_performance(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    def start(raw: DataFrame) -> None:
        stacked = with_event_time(ops.stack_observations(tables.primary(raw), tables.valve_states(raw)))
        streaming.write_append(ops.valve_performance(stacked, "5 days"), path, checkpoint, drain=True)

    _closed(spark, folder, path, start)
    return spark.read.parquet(path).withColumns(
        rounded("pct_open", "pct_closed", "pct_obstructed", "mean_temperature"))


@stream_query(sql.SQL["edit_bytes_per_user"])
def stream_edit_bytes_per_user(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    def start(raw: DataFrame) -> None:
        edits = tables.as_edits(with_event_time(raw))
        streaming.write_append(ops.edit_bytes_per_user(edits, "1 day"), path, checkpoint, drain=True)

    _closed(spark, folder, path, start)
    return spark.read.parquet(path)


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    raw = _events(spark, folder)
    return ops.state_at_reading(
        with_event_time(tables.primary(raw)), with_event_time(tables.valve_states(raw)), PAIR_WINDOW, PAIR_REACH)


@stream_query(sql.SQL["state_at_reading"])
def stream_state_at_reading(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    streaming.write_append(_pairs(spark, folder), path, checkpoint, drain=True)
    return spark.read.parquet(path)


@stream_query(sql.SQL["state_alerts"])
def stream_state_alerts(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    """Both side outputs, each in its own table."""
    tagged = ops.tag_alerts(_pairs(spark, folder), HOT, 80.0)
    streaming.write_routed(tagged, ops.route_alerts, path, checkpoint, drain=True)
    routed = [spark.read.parquet(f"{path}/{name}").drop("batch_id") for name in ("temperature", "obstructed")]
    return routed[0].unionByName(routed[1])


@stream_query(sql.SQL["stolen_vehicles"])
def stream_stolen_vehicles(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    raw = _events(spark, folder)
    activity = ops.vehicle_activity(tables.primary(raw), tables.valve_states(raw), VEHICLE)
    enriched = ops.with_owner(activity, tables.owners(spark, folder))
    streaming.write_append(ops.stolen_vehicles(enriched), path, checkpoint, drain=True)
    return spark.read.parquet(path).select("vehicle_id", "ts", "owner.*")


@stream_query(sql.SQL["dangerous_valves"])
def stream_dangerous_valves(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    _closed(spark, folder, path, lambda raw: streaming.match_patterns_in_batches(
        tables.as_observed(raw), path, checkpoint, heat_above=HOT, drain=True))
    return streaming.read_pattern_alerts(spark, path)


def _chain(spark: SparkSession, folder: str, path: str, checkpoint: str) -> None:
    """Readings with states, pattern, complaints, as one stream."""
    _closed(spark, folder, path, lambda raw: jobs.customer_service_stream(
        tables.as_reports(raw), tables.primary(raw), tables.valve_states(raw), path, checkpoint, True, "2 days",
        VEHICLE, {"size": PAIR_WINDOW, "within": PAIR_REACH}, {"min_times": 2, "heat_above": HOT}))


@stream_query(sql.SQL["pattern_alerts"])
def stream_pattern_alerts(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    _closed(spark, folder, path, lambda raw: jobs.pattern_alerts_stream(
        tables.primary(raw), tables.valve_states(raw), path, checkpoint, True,
        {"size": PAIR_WINDOW, "within": PAIR_REACH}, {"min_times": 2, "heat_above": HOT}))
    return streaming.read_pattern_alerts(spark, path)


@stream_query(sql.SQL["customer_service"])
def stream_customer_service(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    _chain(spark, folder, path, checkpoint)
    return streaming.read_causes(spark, path)


def _reports_and_alerts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    raw = _events(spark, folder)
    return tables.as_reports(raw), ops.heat_alerts(tables.as_measurements(raw), threshold=100.0)


@stream_query(sql.SQL["potential_causes"])
def stream_potential_causes(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    streaming.match_causes_in_batches(
        *_reports_and_alerts(spark, folder), path, checkpoint, "2 days", VEHICLE, drain=True)
    return streaming.read_causes(spark, path)


@stream_query(sql.SQL["potential_causes_sql"])
def stream_potential_causes_sql(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    reports, alerts = _reports_and_alerts(spark, folder)
    ops.publish_reports(reports)
    ops.publish_alerts(alerts)
    streaming.write_append(ops.potential_causes_sql(spark, "1 day", VEHICLE), path, checkpoint, drain=True)
    return spark.read.parquet(path)


@stream_query(sql.SQL["latest_per_vehicle"])
def stream_latest_per_vehicle(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    latest = ops.latest_per_vehicle(*_reports_and_alerts(spark, folder), VEHICLE)
    streaming.append_latest(latest, path, checkpoint, drain=True)
    return _flat(streaming.read_latest(spark, path))


def _flat(latest: DataFrame) -> DataFrame:
    return latest.select(
        "vehicle_id", F.col("complaint.ts").alias("report_ts"),
        F.col("complaint.customer_name").alias("customer_name"), F.col("complaint.value").alias("report_value"),
        F.col("alert.ts").alias("alert_ts"), F.col("alert.sensor_id").alias("sensor_id"),
        F.col("alert.units").alias("units"), F.col("alert.value").alias("alert_value"),
        F.col("alert.level").alias("level"))


@stream_query("""
SELECT vehicle_id, alert_ts AS ts, sensor_id, units, alert_value, level
FROM (%s) WHERE alert_ts IS NOT NULL""" % sql.SQL["latest_per_vehicle"])
def stream_alert_state(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    """The last alert of each vehicle, read from the state table of the complaint matching query."""
    streaming.match_causes_in_batches(
        *_reports_and_alerts(spark, folder), path, checkpoint, "2 days", VEHICLE, drain=True)
    return streaming.read_causes_state(spark, path).where("alert IS NOT NULL").select(
        "vehicle_id", "alert.ts", "alert.sensor_id", "alert.units", F.col("alert.value").alias("alert_value"),
        "alert.level")


# --- in several turns: each adds files, and the query is started anew where it stopped ---------------

def _in_turns(spark: SparkSession, folder: str, path: str, start: Callable[[DataFrame], object]) -> None:
    """Feed the events in ``TURNS`` parts of their arrival order and drain the query ``start`` after each."""
    events, source = tables.events(spark, folder), f"{path}-input"
    first, room = tables.span(events)
    turn = whole((F.col("event_id") - first) * TURNS, room)
    for k in range(TURNS):
        events.where(turn == k).write.mode("append").parquet(source)
        start(spark.readStream.schema(events.schema).parquet(source))


@stream_query(sql.SQL["running_mean_every_third"])
def stream_running_mean_every_third(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    _in_turns(spark, folder, path, lambda raw: streaming.running_mean_in_batches(
        tables.as_measurements(raw), path, checkpoint, every=3, drain=True))
    return streaming.read_running_means(spark, path).withColumns(rounded("mean"))


@stream_query(sql.SQL["running_mean_all_sensors"])
def stream_running_mean_all_sensors(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    _in_turns(spark, folder, path, lambda raw: streaming.running_mean_in_batches(
        tables.as_measurements(raw), path, checkpoint, compat=True, drain=True))
    return streaming.read_running_means(spark, path).withColumns(rounded("mean"))


def _changes(spark: SparkSession, folder: str, path: str, checkpoint: str, rule: str) -> DataFrame:
    def start(raw: DataFrame) -> None:
        readings = tables.as_measurements(raw)
        streaming.changelog_in_batches(readings if rule == "latest" else tables.as_tied(readings), path, checkpoint,
                                       rule, FORCED_SLICE_ROWS if rule == "max_first" else ROWS_PER_SLICE, drain=True)

    _in_turns(spark, folder, path, start)
    return streaming.read_changelog(spark, path)


@stream_query(sql.SQL["max_changelog_last"])
def stream_max_changelog_last(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    return _changes(spark, folder, path, checkpoint, "max_last")


@stream_query(sql.SQL["max_changelog_first"])
def stream_max_changelog_first(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    """With the sliced plan that large keys get."""
    return _changes(spark, folder, path, checkpoint, "max_first")


@stream_query(sql.SQL["latest_changelog"])
def stream_latest_changelog(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    return _changes(spark, folder, path, checkpoint, "latest")


def _latest_in_turns(spark: SparkSession, folder: str, path: str, checkpoint: str) -> None:
    def start(raw: DataFrame) -> None:
        alerts = ops.heat_alerts(tables.as_measurements(raw), threshold=100.0)
        latest = ops.latest_per_vehicle(tables.as_reports(raw), alerts, VEHICLE)
        streaming.write_upserts(latest, path, checkpoint, ["vehicle_id"], drain=True)

    _in_turns(spark, folder, path, start)


@stream_query(sql.SQL["latest_per_vehicle"])
def stream_latest_upserted(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    """The table that is kept by key."""
    _latest_in_turns(spark, folder, path, checkpoint)
    return _flat(streaming.read_upserts(spark, path, ["vehicle_id"]))


@stream_query(sql.SQL["latest_per_vehicle"])
def stream_operator_state(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    """The state that the query itself keeps, read from its checkpoint."""
    _latest_in_turns(spark, folder, path, checkpoint)
    return _flat(streaming.read_latest_state(spark, checkpoint))


@stream_query(sql.of_turn(sql.SQL["latest_per_vehicle"], 0, TURNS))
def stream_operator_state_before(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    """The same state as it was after the first micro-batch."""
    _latest_in_turns(spark, folder, path, checkpoint)
    return _flat(streaming.read_latest_state(spark, checkpoint, batch=0))


@stream_query(f"SELECT user_id AS sensor_id, max(ts) AS ts, {sql._rounded('avg(value)')} AS mean FROM events GROUP BY user_id")
def stream_running_mean_state(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    _in_turns(spark, folder, path, lambda raw: streaming.write_updates(
        ops.running_mean(tables.as_measurements(raw)), path, checkpoint, drain=True))
    return streaming.read_running_means_state(spark, checkpoint).withColumns(rounded("mean"))


@stream_query(sql.SQL["sliding_mean"])
def stream_window_totals(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    """Every turn adds to windows of all others, however late."""
    _in_turns(spark, folder, path, lambda raw: streaming.window_totals_in_batches(
        tables.as_measurements(raw), path, checkpoint, "2 days", "1 day", drain=True))
    return streaming.read_window_means(spark, path).withColumns(rounded("mean"))


@stream_query(sql.PROCESSING_TIME_WINDOWS.format(turn=sql.turn(TURNS)))
def stream_processing_time_windows(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    """Three turns, seven seconds apart on the given clock, in sliding windows of ten seconds."""
    clock = iter(CLOCK_START + dt.timedelta(seconds=7 * k) for k in range(TURNS))
    _in_turns(spark, folder, path, lambda raw: streaming.window_totals_in_batches(
        tables.as_measurements(raw), path, checkpoint, clock=lambda: next(clock), drain=True))
    return streaming.read_window_means(spark, path).withColumns(rounded("mean"))


def _late(spark: SparkSession, folder: str, path: str, checkpoint: str) -> None:
    span = tables.span(tables.events(spark, folder))
    _in_turns(spark, folder, path, lambda raw: streaming.split_late_in_batches(
        tables.arriving_backwards(tables.as_measurements(raw), *span), path, checkpoint, LATE_DELAY, LATE_WINDOW,
        drain=True))


@stream_query(sql.late("late"))
def stream_late_records(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    _late(spark, folder, path, checkpoint)
    return streaming.read_late(spark, path)


@stream_query(sql.late("NOT late"))
def stream_records_in_time(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    _late(spark, folder, path, checkpoint)
    return streaming.read_on_time(spark, path)


def _by_keyed_state(spark: SparkSession, folder: str, path: str, checkpoint: str) -> None:
    def start(raw: DataFrame) -> None:
        timed = with_event_time(raw)
        alerts = ops.heat_alerts(tables.as_measurements(timed), threshold=100.0)
        pairs = streaming.causes_by_keyed_state(
            tables.as_reports(timed), alerts, "2 days", slot="12 hours", sensors_per_vehicle=VEHICLE)
        streaming.write_append(pairs, path, checkpoint, drain=True)

    _closed(spark, folder, path, start, event_type="error", value=1e6)  # a complaint and an alert, which stay in wait


@stream_query(sql.SQL["potential_causes"])
def stream_causes_by_keyed_state(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    _by_keyed_state(spark, folder, path, checkpoint)
    return spark.read.parquet(path)


@stream_query("""
SELECT vehicle_id, alert_ts AS ts, sensor_id, units, alert_value, level
FROM (%s) WHERE alert_ts IS NOT NULL""" % sql.SQL["latest_per_vehicle"])
def stream_named_state(spark: SparkSession, folder: str, path: str, checkpoint: str) -> DataFrame:
    """The value state ``alerts`` of the same query, read from its checkpoint."""
    _by_keyed_state(spark, folder, path, checkpoint)
    return streaming.read_processor_state(spark, checkpoint, "alerts").select(
        "vehicle_id", "ts", "sensor_id", "units", F.col("value").alias("alert_value"), "level")
