"""Complaints and alerts matched by a keyed processor with named state and event-time timers.

Each vehicle has two single values, ``complaints`` and ``alerts``, the last of each; both can be read from outside
while the query runs (:func:`read_processor_state`).  Rows wait for the end of their slot of event time.  When the
watermark has passed the end of a slot, its rows are taken in exact ``(ts, report before alert, seq)`` order, so
neither the cut into micro-batches nor the size of the transfers to Python decides the order.

A vehicle has one timer, for the end of its first waiting slot, which takes all slots that have ended.  Up to
``whole_rows`` rows of a vehicle wait as they came, so the calls grow with the vehicles and not with their slots;
further ones wait by slot.  A vehicle's rows go to one task, which holds those and one slot of the others at a time.
Where one vehicle has more rows in a slot than a task can hold, take :func:`~fleetlens.streaming.match_complaints_with_patterns` or
:func:`~fleetlens.streaming.match_causes_in_batches`, which cut the timeline of a vehicle between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from fleetlens.functions import interval_micros, micros
from fleetlens.operators.causes import stack_reports_and_alerts
from fleetlens.schemas import SENSORS_PER_VEHICLE

COMPLAINTS_STATE, ALERTS_STATE = "complaints", "alerts"
WHOLE_ROWS = 10_000
_LAST = (1 << 63) - 1
_COMPLAINT = "us long, seq long, customer_name string, value string"
_ALERT = "us long, seq long, sensor_id long, units string, value double, level int"
_PAIR = ("vehicle_id long, report_us long, customer_name string, report_value string, alert_us long, sensor_id long, "
         "units string, alert_value double, level int")


def _processor(within: int, slot: int, whole_rows: int) -> StatefulProcessor:
    """Made inside a function, so that it travels to the workers by value and they need not have this package.

    ``within`` is in microseconds, ``slot`` in milliseconds.
    """
    columns = {"us": "int64", "place": "int64", "seq": "int64", "name": "string", "report_value": "string",
               "sensor_id": "int64", "alert_value": "float64", "level": "int32"}
    complaint_fields = ["us", "seq", "name", "report_value"]
    alert_fields = ["us", "seq", "sensor_id", "name", "alert_value", "level"]
    names = [field.split()[0] for field in _PAIR.split(", ")]

    def schema() -> Any:
        import pyarrow as pa

        return pa.schema([pa.field(name, kind) for name, kind in columns.items()])

    def starts_of(rows: Any) -> Any:
        return rows["us"].to_numpy() // (1000 * slot) * slot

    def pack(rows: Any) -> tuple[bytes]:
        import pyarrow as pa

        stream = pa.BufferOutputStream()
        with pa.ipc.new_stream(stream, rows.schema) as writer:
            writer.write_table(rows)
        return (stream.getvalue().to_pybytes(),)

    def unpack(value: Any) -> Any:
        import pyarrow as pa

        return pa.ipc.open_stream(bytes(value[0])).read_all()

    def row_at(rows: Any, fields: list[str], at: int) -> tuple[Any, ...]:
        return tuple(rows[name][int(at)].as_py() for name in fields)

    class Causes(StatefulProcessor):
        def init(self, handle: Any) -> None:
            self.handle = handle
            self.complaint = handle.getValueState(COMPLAINTS_STATE, _COMPLAINT)
            self.alert = handle.getValueState(ALERTS_STATE, _ALERT)
            # how many rows wait in ``whole``, how many slots in ``parts``, and the time of the only timer
            self.held = handle.getValueState("held", "n int, slots int, due long")
            self.whole = handle.getListState("whole", "rows binary")
            self.parts = handle.getMapState("parts", "slot long", "n int")
            self.waiting = handle.getMapState("waiting", "slot long, part int", "rows binary")

        def handleInputRows(self, key: Any, rows: Iterator[Any], timerValues: Any) -> Iterator[Any]:
            import numpy as np
            import pyarrow as pa

            held = self.held.get()
            n, slots, due = (0, 0, None) if held is None else held
            first, fields = due, schema()
            for frame in rows:
                batch = pa.Table.from_arrays([pa.array(
                    frame[field.name].to_numpy(), field.type, from_pandas=True) for field in fields], schema=fields)
                starts = starts_of(batch)
                end = int(starts.min()) + slot
                first = end if first is None else min(first, end)
                if n + len(batch) <= whole_rows:
                    self.whole.appendValue(pack(batch))
                    n += len(batch)
                    continue
                for start in np.unique(starts).tolist():
                    known = self.parts.getValue((start,))
                    k = 0 if known is None else known[0]
                    slots += k == 0
                    self.waiting.updateValue((start, k), pack(batch.filter(starts == start)))
                    self.parts.updateValue((start,), (k + 1,))
            if first != due:
                if due is not None:
                    self.handle.deleteTimer(due)
                self.handle.registerTimer(first)
            self.held.update((n, slots, first))
            return iter([])

        def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Any]:
            import pyarrow as pa

            # slots that start before it have ended
            end = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() // slot * slot)
            n, slots, _ = self.held.get()
            complaint, alert = known = self.complaint.get(), self.alert.get()
            ready, due = None, []
            if n:
                whole = pa.concat_tables([unpack(value) for value in self.whole.get()])
                passed = starts_of(whole) < end
                ready, later = whole.filter(passed), whole.filter(~passed)
                if len(later) < n:
                    if len(later):
                        self.whole.put([pack(later)])
                    else:
                        self.whole.clear()
                    n = len(later)
                if n:
                    due.append(int(starts_of(later).min()))
            if slots:
                waiting = sorted(start for (start,) in self.parts.keys())
                due += [start for start in waiting if start >= end][:1]
                for start in (start for start in waiting if start < end):
                    held = []
                    for part in range(self.parts.getValue((start,))[0]):
                        held.append(unpack(self.waiting.getValue((start, part))))
                        self.waiting.removeKey((start, part))
                    self.parts.removeKey((start,))
                    slots -= 1
                    if ready is not None:
                        behind = starts_of(ready) > start
                        held.append(ready.filter(~behind))
                        ready = ready.filter(behind)
                    complaint, alert, found = self.match(key, pa.concat_tables(held), complaint, alert)
                    if len(found):
                        yield found
            if ready is not None and len(ready):
                complaint, alert, found = self.match(key, ready, complaint, alert)
                if len(found):
                    yield found
            if complaint is not known[0]:
                self.complaint.update(complaint)
            if alert is not known[1]:
                self.alert.update(alert)
            if due:
                self.handle.registerTimer(min(due) + slot)
                self.held.update((n, slots, min(due) + slot))
            else:
                self.held.clear()

        def match(self, key: Any, rows: Any, complaint: Any, alert: Any) -> tuple[Any, Any, Any]:
            """The last complaint and the last alert after all rows, and the pairs that the rows make on the way."""
            import numpy as np
            import pandas as pd
            import pyarrow as pa
            import pyarrow.compute as pc

            tie = pc.if_else(rows["report_value"].is_valid(), "", rows["name"])
            ordered = rows.take(pc.sort_indices(
                rows.append_column("tie", tie), [(name, "ascending") for name in ("us", "place", "tie")]))
            known = [dict(zip(fields, last)) for fields, last in (
                (complaint_fields, complaint), (alert_fields, alert)) if last is not None]
            if known:
                ordered = pa.concat_tables([pa.Table.from_pylist(known, rows.schema), ordered])
            is_report, at = ordered["report_value"].is_valid().to_numpy(), np.arange(len(ordered))
            reports = np.maximum.accumulate(np.where(is_report, at, -1))
            alerts = np.maximum.accumulate(np.where(is_report, -1, at))
            us = ordered["us"].to_numpy()
            both = (at >= len(known)) & (reports >= 0) & (alerts >= 0) & (np.abs(us[reports] - us[alerts]) < within)
            told, raised = ordered.take(reports[both]), ordered.take(alerts[both])
            found = pd.DataFrame(dict(zip(names, [
                np.repeat(np.array([key[0]]), len(told)),
                *[told[name].to_numpy() for name in complaint_fields if name != "seq"],
                *[raised[name].to_numpy() for name in alert_fields if name != "seq"]])))
            if reports[-1] >= len(known):
                complaint = row_at(ordered, complaint_fields, reports[-1])
            if alerts[-1] >= len(known):
                alert = row_at(ordered, alert_fields, alerts[-1])
            return complaint, alert, found

        def close(self) -> None:
            pass

    return Causes()


def causes_by_keyed_state(
    reports: DataFrame, alerts: DataFrame, within: str = "2 hours", slot: str = "1 minute",
    sensors_per_vehicle: int = SENSORS_PER_VEHICLE, whole_rows: int = WHOLE_ROWS,
) -> DataFrame:
    """``potential_causes`` of two streams, in event-time order; append mode.

    Both streams come with their watermark (``with_event_time``), and time goes on with the slower one.  Spark
    applies filters before watermarks where it can, so only complaints and alerts move it on, not other records.
    A row at or behind the watermark on arrival is dropped, as by every stateful operator; before the first event
    it is the start of 1970.
    """
    # times and places are never NULL: a transfer that holds a NULL turns whole numbers into floats
    flat = stack_reports_and_alerts(reports, alerts, sensors_per_vehicle).where("ts IS NOT NULL").select(
        "vehicle_id", "ts", micros("ts").alias("us"), F.coalesce("seq", F.lit(_LAST)).alias("place"),
        F.coalesce("report.seq", "alert.seq", F.lit(0)).alias("seq"),
        F.coalesce("report.customer_name", "alert.units").alias("name"),  # each row is one of the two
        F.col("report.value").alias("report_value"), F.coalesce("alert.sensor_id", F.lit(0)).alias("sensor_id"),
        F.col("alert.value").alias("alert_value"), F.coalesce("alert.level", F.lit(0)).alias("level"))
    pairs = flat.groupBy("vehicle_id").transformWithStateInPandas(
        _processor(interval_micros(within), interval_micros(slot) // 1000, whole_rows), _PAIR, "append", "eventtime")
    return pairs.select(
        "vehicle_id", F.timestamp_micros("report_us").alias("report_ts"), "customer_name", "report_value",
        F.timestamp_micros("alert_us").alias("alert_ts"), "sensor_id", "units", "alert_value", "level")


def read_processor_state(spark: SparkSession, checkpoint: str, name: str, batch: int | None = None) -> DataFrame:
    """The value state ``complaints`` or ``alerts`` per vehicle of a running :func:`causes_by_keyed_state`."""
    if name not in (COMPLAINTS_STATE, ALERTS_STATE):
        raise ValueError(f"the state is {COMPLAINTS_STATE!r} or {ALERTS_STATE!r}, not {name!r}")
    reader = spark.read.format("statestore").option("stateVarName", name)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint).select("key.vehicle_id", F.timestamp_micros("value.us").alias("ts"), "value.*").drop("us")
