"""The SQL form: reports and alerts as views, and the interval join over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.functions import interval_micros
from fleetlens.schemas import CUSTOMER_REPORT, SENSORS_PER_VEHICLE, SENSOR_ALERT, expect
from fleetlens.sources import with_event_time

# A report is offered to every slot of length {slot} its band touches (two, or three at an edge) and an
# alert sits in one slot, so each pair is found once and the join never compares a report with alerts
# further away than that, however many a vehicle has.
POTENTIAL_CAUSES_SQL = """
SELECT c.vehicle_id, c.customer_name, c.report_value, c.report_time,
       a.sensor_id, a.units, a.alert_value, a.level
FROM (
    SELECT *, explode(sequence(
        floor((unix_micros(report_time) - {band}) / {slot}D),
        floor((unix_micros(report_time) + {band}) / {slot}D))) AS slot
    FROM {reports}
    WHERE report_value IN ('BROKEN_DOWN', 'DISSATISFIED')
) c, (
    SELECT *, sensor_id div {sensors} AS vehicle_id, floor(unix_micros(alert_time) / {slot}D) AS slot
    FROM {alerts}
) a
WHERE c.vehicle_id = a.vehicle_id
  AND c.slot = a.slot
  AND a.alert_time BETWEEN c.report_time - INTERVAL {within} AND c.report_time + INTERVAL {within}
"""


def publish_reports(reports: DataFrame, view: str = "customer_reports") -> None:
    """Register the reports as a view with an event-time column ``report_time``."""
    expect(reports, CUSTOMER_REPORT)
    with_event_time(reports.select(
        "vehicle_id", "customer_name", F.col("value").alias("report_value"),
        F.col("ts").alias("report_time")), column="report_time").createOrReplaceTempView(view)


def publish_alerts(alerts: DataFrame, view: str = "telemetry_alerts") -> None:
    """Register the alerts as a view with an event-time column ``alert_time``."""
    expect(alerts, SENSOR_ALERT)
    with_event_time(alerts.select(
        "sensor_id", "units", F.col("value").alias("alert_value"), "level",
        F.col("ts").alias("alert_time")), column="alert_time").createOrReplaceTempView(view)


def potential_causes_sql(
    spark: SparkSession,
    within: str = "1 hour",
    sensors_per_vehicle: int = SENSORS_PER_VEHICLE,
    reports: str = "customer_reports",
    alerts: str = "telemetry_alerts",
) -> DataFrame:
    """Complaints with every alert of the vehicle no further than ``within`` before or after, inclusive."""
    band = interval_micros(within)
    return spark.sql(POTENTIAL_CAUSES_SQL.format(
        band=band, slot=2 * band, within=within, sensors=sensors_per_vehicle, reports=reports, alerts=alerts))
