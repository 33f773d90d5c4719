"""Complaints matched with alerts of the same vehicle, and the latest of each per vehicle."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from fleetlens.functions import interval_micros, is_complaint, micros, vehicle_of
from fleetlens.plans import Slices, ordered_scan
from fleetlens.plans.slices import ROWS_PER_SLICE
from fleetlens.schemas import CUSTOMER_REPORT, SENSORS_PER_VEHICLE, SENSOR_ALERT, expect

_UPTO = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)
_ALERT_FIRST = 1 << 62  # arrival numbers stay below; puts alerts behind the reports of the same instant
_ORDER = ["ts", "seq", "tie"]
REPORT, ALERT, KNOWN = "report", "alert", "known"


def _report() -> Column:
    return F.struct("ts", "seq", "customer_name", "value")


def _alert() -> Column:
    return F.struct("ts", "seq", "sensor_id", "units", "value", "level")


def stack_reports_and_alerts(
    reports: DataFrame, alerts: DataFrame, sensors_per_vehicle: int = SENSORS_PER_VEHICLE
) -> DataFrame:
    """Complaints and alerts as one bag keyed by vehicle; other reports are dropped before any shuffle.

    Columns: ``vehicle_id, ts, seq, tie, kind, report STRUCT, alert STRUCT``; the struct of the other kind
    is NULL.  ``seq`` orders reports before alerts of the same instant, ``tie`` alerts of the same record.
    """
    expect(reports, CUSTOMER_REPORT)
    expect(alerts, SENSOR_ALERT)
    complaints = reports.where(is_complaint("value")).select(
        "vehicle_id", "ts", "seq", F.lit("").alias("tie"), F.lit(REPORT).alias("kind"), _report().alias("report"))
    marked = alerts.select(
        vehicle_of("sensor_id", sensors_per_vehicle).alias("vehicle_id"), "ts",
        (F.col("seq") + F.lit(_ALERT_FIRST)).alias("seq"), F.col("units").alias("tie"), F.lit(ALERT).alias("kind"),
        _alert().alias("alert"))
    return complaints.unionByName(marked, allowMissingColumns=True)


def potential_causes(
    reports: DataFrame,
    alerts: DataFrame,
    within: str = "2 hours",
    sensors_per_vehicle: int = SENSORS_PER_VEHICLE,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """A complaint with the last alert before it, and an alert with the last complaint before it.

    Both only if strictly closer than ``within``.  Order is ``(ts, report before alert, seq)``.
    """
    stacked = stack_reports_and_alerts(reports, alerts, sensors_per_vehicle)
    return match_stacked(stacked, within, slices, rows_per_slice)


def match_stacked(
    stacked: DataFrame, within: str, slices: Slices | None = None, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """:func:`potential_causes` over an already stacked bag.

    Rows of kind ``known`` carry a report and an alert from before; they start a vehicle off and emit
    nothing themselves.
    """
    shapes = {f.name: f.dataType.simpleString() for f in stacked.schema.fields}
    scanned = ordered_scan(
        stacked, ["vehicle_id"], _ORDER,
        local=lambda w: [{
            "_report": F.last("report", ignorenulls=True).over(w.rowsBetween(*_UPTO)),
            "_alert": F.last("alert", ignorenulls=True).over(w.rowsBetween(*_UPTO)),
        }],
        totals={"_last_report": last_seen("report"), "_last_alert": last_seen("alert")},
        inherit=lambda w: [{
            "_prior_report": F.last("_last_report", ignorenulls=True).over(w.rowsBetween(*_BEFORE)),
            "_prior_alert": F.last("_last_alert", ignorenulls=True).over(w.rowsBetween(*_BEFORE)),
        }],
        inherited=f"_prior_report {shapes['report']}, _prior_alert {shapes['alert']}",
        slices=slices, rows_per_slice=rows_per_slice,
    )
    pairs = scanned.where(F.col("kind") != KNOWN).select(
        "vehicle_id", F.coalesce("_report", "_prior_report").alias("report"),
        F.coalesce("_alert", "_prior_alert").alias("alert"))
    return near(pairs, within)


def last_seen(kind: str) -> Column:
    """Aggregate: the last ``report`` or ``alert`` of a stacked bag in its order."""
    return F.max_by(kind, F.when(F.col(kind).isNotNull(), F.struct(*_ORDER)))


def near(pairs: DataFrame, within: str) -> DataFrame:
    """Flatten (report, alert) pairs that are strictly closer than ``within``."""
    gap = F.abs(micros("report.ts") - micros("alert.ts"))
    return pairs.where(gap < interval_micros(within)).select(
        "vehicle_id",
        F.col("report.ts").alias("report_ts"), F.col("report.customer_name").alias("customer_name"),
        F.col("report.value").alias("report_value"),
        F.col("alert.ts").alias("alert_ts"), F.col("alert.sensor_id").alias("sensor_id"),
        F.col("alert.units").alias("units"), F.col("alert.value").alias("alert_value"),
        F.col("alert.level").alias("level"),
    )


def latest_per_vehicle(
    reports: DataFrame, alerts: DataFrame, sensors_per_vehicle: int = SENSORS_PER_VEHICLE
) -> DataFrame:
    """The last complaint and the last alert of each vehicle, NULL where there was none.

    Reduced inside the scan tasks.  On a stream use ``update`` mode, or keep a table up to date with
    :func:`fleetlens.streaming.append_latest`.
    """
    stacked = stack_reports_and_alerts(reports, alerts, sensors_per_vehicle)
    return stacked.groupBy("vehicle_id").agg(
        last_seen("report").alias("complaint"), last_seen("alert").alias("alert"))


def lookup(latest: DataFrame, vehicle_id: int, what: str) -> Row | None:
    """The ``complaint`` or ``alert`` of one vehicle from a table of :func:`latest_per_vehicle`."""
    if what not in ("complaint", "alert"):
        raise ValueError(f"what is 'complaint' or 'alert', not {what!r}")
    found: list[Any] = latest.where(F.col("vehicle_id") == vehicle_id).select(what).take(1)
    return found[0][0] if found else None
