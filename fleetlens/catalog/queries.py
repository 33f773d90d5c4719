"""Batch queries.

The test tables cover 30 days with about 67 readings per sensor, so windows, thresholds and bands are
wider or lower here than the native defaults.  Queries whose name ends in ``_sliced`` force the
time-sliced plan that large keys get by themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fleetlens import jobs, operators as ops
from fleetlens.schemas import SENSOR_REFERENCE
from fleetlens.sources import shared_tables as tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HOT = 60.0
PATTERN_TTL = "4 days"
PAIR_WINDOW, PAIR_REACH = "1 day", "12 hours"
VEHICLE = tables.SENSORS_PER_TEST_VEHICLE
FORCED_SLICE_ROWS = 60
SOME_SLICE_ROWS = 2_000  # for scans over all sensors together
LATE_DELAY, LATE_WINDOW = "1 day", "1 day"


def finish(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as in the SQL twins."""
    def plain(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)
    return df.select(*[plain(f) for f in df.schema.fields])


def rounded(*names: str) -> dict[str, Column]:
    """Means to six decimals, as sums differ in their last bits with the order of summation.

    The small addend, the same in the SQL twins, keeps means that end in a five off the rounding edge.
    """
    return {n: F.round(F.col(n) + 1e-9, 6) for n in names}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return finish(fn(spark, folder))

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return fn


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    return tables.as_measurements(tables.events(spark, folder))


# --- projections and words -------------------------------------------------------------------------

@query
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return ops.word_count(tables.table(spark, folder, "documents"), "text")


@query
def word_count_changelog(spark: SparkSession, folder: str) -> DataFrame:
    documents = tables.table(spark, folder, "documents").withColumnRenamed("doc_id", "seq")
    return ops.word_count_changelog(documents, "text")


@query
def to_fahrenheit(spark: SparkSession, folder: str) -> DataFrame:
    return ops.to_fahrenheit(_readings(spark, folder))


@query
def fahrenheit_and_celsius(spark: SparkSession, folder: str) -> DataFrame:
    return ops.fahrenheit_and_celsius(_readings(spark, folder))


@query
def heat_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return ops.heat_alerts(_readings(spark, folder), threshold=150.0)


@query
def tag_readings(spark: SparkSession, folder: str) -> DataFrame:
    raw = tables.events(spark, folder)
    return ops.tag_readings(tables.primary(raw), tables.secondary(raw))


@query
def vehicle_activity(spark: SparkSession, folder: str) -> DataFrame:
    raw = tables.events(spark, folder)
    return ops.vehicle_activity(tables.primary(raw), tables.valve_states(raw), VEHICLE)


def _backwards(spark: SparkSession, folder: str) -> DataFrame:
    raw = tables.events(spark, folder)
    return tables.arriving_backwards(tables.as_measurements(raw), *tables.span(raw))


@query
def late_records(spark: SparkSession, folder: str) -> DataFrame:
    marked = ops.mark_late(_backwards(spark, folder), LATE_DELAY, LATE_WINDOW)
    return marked.where("late").drop("late")


@query
def late_records_sliced(spark: SparkSession, folder: str) -> DataFrame:
    marked = ops.mark_late(_backwards(spark, folder), LATE_DELAY, LATE_WINDOW, rows_per_slice=SOME_SLICE_ROWS)
    return marked.where("late").drop("late")


# --- rolling ---------------------------------------------------------------------------------------

@query
def latest_observation(spark: SparkSession, folder: str) -> DataFrame:
    return ops.latest_observation(_readings(spark, folder))


@query
def latest_observation_of_sensor(spark: SparkSession, folder: str) -> DataFrame:
    return ops.latest_observation(_readings(spark, folder), sensor_id=7)


@query
def max_reading_last(spark: SparkSession, folder: str) -> DataFrame:
    return ops.max_reading(tables.as_tied(_readings(spark, folder)), tie="last")


@query
def max_reading_first(spark: SparkSession, folder: str) -> DataFrame:
    return ops.max_reading(tables.as_tied(_readings(spark, folder)), tie="first")


@query
def max_changelog_last(spark: SparkSession, folder: str) -> DataFrame:
    return ops.reading_changelog(tables.as_tied(_readings(spark, folder)), "max_last")


@query
def max_changelog_first(spark: SparkSession, folder: str) -> DataFrame:
    return ops.reading_changelog(tables.as_tied(_readings(spark, folder)), "max_first")


@query
def max_changelog_first_sliced(spark: SparkSession, folder: str) -> DataFrame:
    return ops.reading_changelog(
        tables.as_tied(_readings(spark, folder)), "max_first", rows_per_slice=FORCED_SLICE_ROWS)


@query
def latest_changelog(spark: SparkSession, folder: str) -> DataFrame:
    return ops.reading_changelog(_readings(spark, folder), "latest")


@query
def running_mean(spark: SparkSession, folder: str) -> DataFrame:
    return ops.running_mean(_readings(spark, folder)).withColumns(rounded("mean"))


@query
def running_mean_sliced(spark: SparkSession, folder: str) -> DataFrame:
    return ops.running_mean(
        _readings(spark, folder), rows_per_slice=FORCED_SLICE_ROWS).withColumns(rounded("mean"))


@query
def running_mean_every_third(spark: SparkSession, folder: str) -> DataFrame:
    return ops.running_mean(_readings(spark, folder), every=3).withColumns(rounded("mean"))


@query
def running_mean_all_sensors(spark: SparkSession, folder: str) -> DataFrame:
    return ops.running_mean(
        _readings(spark, folder), compat=True, rows_per_slice=1_000).withColumns(rounded("mean"))


# --- windows ---------------------------------------------------------------------------------------

@query
def sliding_mean(spark: SparkSession, folder: str) -> DataFrame:
    return ops.sliding_mean(_readings(spark, folder), "2 days", "1 day").withColumns(rounded("mean"))


@query
def sensor_deviation(spark: SparkSession, folder: str) -> DataFrame:
    tagged = tables.as_tagged(tables.events(spark, folder))
    return ops.sensor_deviation(tagged, "3 days").withColumns(rounded("value"))


@query
def sensor_deviation_compat(spark: SparkSession, folder: str) -> DataFrame:
    tagged = tables.as_tagged(tables.events(spark, folder))
    return ops.sensor_deviation(tagged, "3 days", compat=True).withColumns(rounded("value"))


@query
def valve_performance(spark: SparkSession, folder: str) -> DataFrame:
    stacked = tables.as_stacked(tables.events(spark, folder))
    return ops.valve_performance(stacked, "5 days").withColumns(
        rounded("pct_open", "pct_closed", "pct_obstructed", "mean_temperature"))


@query
def edit_bytes_per_user(spark: SparkSession, folder: str) -> DataFrame:
    return ops.edit_bytes_per_user(tables.as_edits(tables.events(spark, folder)), "1 day")


# --- joins and enrichment --------------------------------------------------------------------------

def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    raw = tables.events(spark, folder)
    return ops.state_at_reading(tables.primary(raw), tables.valve_states(raw), PAIR_WINDOW, PAIR_REACH)


@query
def state_at_reading(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(spark, folder)


@query
def state_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return ops.state_alerts(_pairs(spark, folder), HOT, 80.0)


@query
def state_alerts_compat(spark: SparkSession, folder: str) -> DataFrame:
    return ops.state_alerts(_pairs(spark, folder), HOT, 80.0, compat=True)


@query
def obstructed_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return ops.route_alerts(ops.tag_alerts(_pairs(spark, folder), HOT, 80.0))["obstructed"]


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    raw = tables.events(spark, folder)
    activity = ops.vehicle_activity(tables.primary(raw), tables.valve_states(raw), VEHICLE)
    return ops.with_owner(activity, tables.owners(spark, folder))


@query
def with_owner(spark: SparkSession, folder: str) -> DataFrame:
    return _enriched(spark, folder).select("state.*", "owner.*")


@query
def stolen_vehicles(spark: SparkSession, folder: str) -> DataFrame:
    return ops.stolen_vehicles(_enriched(spark, folder)).select("vehicle_id", "ts", "owner.*")


@query
def owner_names(spark: SparkSession, folder: str) -> DataFrame:
    return tables.owners(spark, folder)


@query
def with_owner_name(spark: SparkSession, folder: str) -> DataFrame:
    """Reports under the owner's name from the owner table; NULL without an owner."""
    reports = tables.as_reports(tables.events(spark, folder)).drop("customer_name")
    names = tables.owners(spark, folder).select("vehicle_id", F.col("owner_name").alias("customer_name"))
    return reports.join(names, "vehicle_id", "left")


@query
def with_sensor_reference(spark: SparkSession, folder: str) -> DataFrame:
    sensors = tables.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("sensor_id"), F.col("s_acctbal").alias("lon"),
        F.col("s_nationkey").cast("double").alias("lat"), F.col("s_name").alias("important_metadata"),
        F.lower("s_name").alias("more_important_metadata"))
    enriched = ops.with_sensor_reference(_readings(spark, folder), sensors)
    return enriched.select(
        "measurement.*", *[F.col(f"sensor_reference.{n}") for n in SENSOR_REFERENCE.names if n != "sensor_id"])


# --- patterns, complaints, SQL ---------------------------------------------------------------------

def _observed(spark: SparkSession, folder: str) -> DataFrame:
    return tables.as_observed(tables.events(spark, folder))


@query
def dangerous_valves(spark: SparkSession, folder: str) -> DataFrame:
    return ops.dangerous_valves(_observed(spark, folder), heat_above=HOT)


@query
def dangerous_valves_sliced(spark: SparkSession, folder: str) -> DataFrame:
    return ops.dangerous_valves(_observed(spark, folder), heat_above=HOT, rows_per_slice=FORCED_SLICE_ROWS)


@query
def dangerous_valves_compat(spark: SparkSession, folder: str) -> DataFrame:
    return ops.dangerous_valves(_observed(spark, folder), heat_above=HOT, compat=True)


@query
def dangerous_valves_compat_sliced(spark: SparkSession, folder: str) -> DataFrame:
    return ops.dangerous_valves(_observed(spark, folder), heat_above=HOT, compat=True, rows_per_slice=FORCED_SLICE_ROWS)


@query
def dangerous_valves_ttl(spark: SparkSession, folder: str) -> DataFrame:
    return ops.dangerous_valves(_observed(spark, folder), heat_above=HOT, ttl=PATTERN_TTL)


@query
def dangerous_valves_longest(spark: SparkSession, folder: str) -> DataFrame:
    return ops.dangerous_valves(_observed(spark, folder), heat_above=HOT, after_match="first")


def _reports_and_alerts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    raw = tables.events(spark, folder)
    return tables.as_reports(raw), ops.heat_alerts(tables.as_measurements(raw), threshold=100.0)


@query
def potential_causes(spark: SparkSession, folder: str) -> DataFrame:
    return ops.potential_causes(*_reports_and_alerts(spark, folder), "2 days", VEHICLE)


@query
def potential_causes_sliced(spark: SparkSession, folder: str) -> DataFrame:
    return ops.potential_causes(
        *_reports_and_alerts(spark, folder), "2 days", VEHICLE, rows_per_slice=FORCED_SLICE_ROWS)


@query
def potential_causes_sql(spark: SparkSession, folder: str) -> DataFrame:
    reports, alerts = _reports_and_alerts(spark, folder)
    ops.publish_reports(reports)
    ops.publish_alerts(alerts)
    return ops.potential_causes_sql(spark, "1 day", VEHICLE)


@query
def latest_per_vehicle(spark: SparkSession, folder: str) -> DataFrame:
    latest = ops.latest_per_vehicle(*_reports_and_alerts(spark, folder), VEHICLE)
    return latest.select(
        "vehicle_id", F.col("complaint.ts").alias("report_ts"),
        F.col("complaint.customer_name").alias("customer_name"), F.col("complaint.value").alias("report_value"),
        F.col("alert.ts").alias("alert_ts"), F.col("alert.sensor_id").alias("sensor_id"),
        F.col("alert.units").alias("units"), F.col("alert.value").alias("alert_value"),
        F.col("alert.level").alias("level"))


@query
def customer_service(spark: SparkSession, folder: str) -> DataFrame:
    """The whole chain: readings joined with states, pattern alerts, matched with complaints."""
    raw = tables.events(spark, folder)
    return jobs.customer_service(
        tables.as_reports(raw), tables.primary(raw), tables.valve_states(raw), "2 days", VEHICLE,
        pairs={"size": PAIR_WINDOW, "within": PAIR_REACH}, pattern={"min_times": 2, "heat_above": HOT})


@query
def pattern_alerts(spark: SparkSession, folder: str) -> DataFrame:
    raw = tables.events(spark, folder)
    return jobs.pattern_alerts(
        tables.primary(raw), tables.valve_states(raw), {"size": PAIR_WINDOW, "within": PAIR_REACH},
        {"min_times": 2, "heat_above": HOT})
