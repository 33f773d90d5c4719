import datetime as dt
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import ms_of, rows_of
from fleetlens import operators as ops, schemas, streaming
from fleetlens.sources import (
    from_elements, load_measurements, load_records, load_text_lines, load_valve_states, with_event_time,
    with_processing_time,
)
from test_causes import HOUR, PAIR, _loop
from test_patterns import brute_force

ARROW = {"timestamp": pa.timestamp("us", tz="UTC"), "bigint": pa.int64(), "double": pa.float64(),
         "string": pa.string(), "int": pa.int32()}


class Feed:
    """A folder that a file stream reads, one file per micro-batch, in the order of adding."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.n = spark, str(folder), schema, 0
        os.makedirs(self.folder)

    def add(self, *rows):
        columns = {
            f.name: pa.array([dt.datetime.fromtimestamp(r[i] / 1000, dt.timezone.utc)
                              if f.name == "ts" else r[i] for r in rows], ARROW[f.dataType.simpleString()])
            for i, f in enumerate(self.schema.fields)}
        path = f"{self.folder}/part-{self.n:04d}.parquet"
        pq.write_table(pa.table(columns), path)
        os.utime(path, (1_700_000_000 + self.n, 1_700_000_000 + self.n))
        self.n += 1
        return self

    def stream(self):
        return load_records(self.spark, self.folder, self.schema, stream=True, max_files_per_trigger=1)

    def table(self):
        return load_records(self.spark, self.folder, self.schema)


@pytest.fixture
def feed(spark, tmp_path):
    return lambda name, schema: Feed(spark, tmp_path / name, schema)


def reading(ms, sensor, value, seq=0):
    return (ms, sensor, "CELSIUS", float(value), seq)


def drained(spark, df, tmp_path, name="out"):
    query = streaming.write_append(df, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"), drain=True)
    return query, spark.read.parquet(str(tmp_path / name))


def test_loaders_read_the_same_as_table_and_stream(spark, feed, tmp_path, tables):
    fed = feed("in", schemas.MEASUREMENT).add(reading(1, 1, 2.0)).add(reading(2, 1, 3.0))
    _, out = drained(spark, load_measurements(spark, fed.folder, stream=True), tmp_path)
    assert rows_of(out) == rows_of(load_measurements(spark, fed.folder)) != []
    states = tables.states((5, 1, "OPEN"))
    for fmt in ("json", "orc", "csv"):
        states.write.format(fmt).save(str(tmp_path / fmt))
        assert rows_of(load_valve_states(spark, str(tmp_path / fmt), fmt=fmt)) == rows_of(states)


def test_elements_and_text_lines(spark, tmp_path):
    words = from_elements(spark, [("hello",), ("stream",), ("world",)], schemas.TEXT_LINE)
    words.write.text(str(tmp_path / "lines"))
    assert rows_of(load_text_lines(spark, str(tmp_path / "lines"))) == [("hello",), ("stream",), ("world",)]
    counts = ops.running_word_count(load_text_lines(spark, str(tmp_path / "lines"), stream=True))
    streaming.write_updates(counts, str(tmp_path / "counts"), str(tmp_path / "checkpoint"), drain=True)
    assert rows_of(streaming.read_current(spark, str(tmp_path / "counts"), ["word"])) == [
        ("hello", 1), ("stream", 1), ("world", 1)]
    with pytest.raises(ValueError):
        ops.running_word_count(words)


def test_sliding_mean_replayed_equals_the_table(spark, feed, tmp_path):
    rng = random.Random(7)
    fed = feed("in", schemas.MEASUREMENT)
    for batch in range(4):
        fed.add(*[reading(batch * 20_000 + rng.randrange(20_000), rng.randrange(3), rng.randrange(600))
                  for _ in range(40)])
    expected = rows_of(ops.sliding_mean(fed.table()))
    fed.add(reading(10_000_000, 99, 0.0))  # pushes the watermark past everything
    _, out = drained(spark, ops.sliding_mean(with_event_time(fed.stream())), tmp_path)
    assert rows_of(out.where("sensor_id < 99")) == expected


def test_late_rows_are_dropped(spark, feed, tmp_path):
    fed = feed("in", schemas.MEASUREMENT)
    fed.add(reading(1_000, 1, 10.0)).add(reading(20_000, 1, 20.0)).add(reading(21_000, 1, 20.0))
    fed.add(reading(1_500, 1, 500.0)).add(reading(900_000, 1, 0.0))
    query, out = drained(spark, ops.sliding_mean(with_event_time(fed.stream())), tmp_path)
    assert (10.0,) in rows_of(out.where("window_start = timestamp_millis(0)"), "mean")
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped > 0


def test_append_without_watermark_is_refused(spark, feed, tmp_path):
    fed = feed("in", schemas.MEASUREMENT).add(reading(1, 1, 1.0))
    with pytest.raises(AnalysisException, match="watermark"):
        drained(spark, ops.sliding_mean(fed.stream()), tmp_path)


def test_rolling_forms_keep_their_ties_across_batches(spark, feed, tmp_path):
    fed = feed("in", schemas.MEASUREMENT)
    fed.add(reading(10, 1, 5.0, 0)).add(reading(10, 1, 5.0, 1), reading(3, 2, 1.0, 2))
    for name, df in (("latest", ops.latest_observation(fed.stream())),
                     ("first", ops.max_reading(fed.stream(), "first")),
                     ("last", ops.max_reading(fed.stream(), "last"))):
        streaming.write_updates(df, str(tmp_path / name), str(tmp_path / f"{name}-c"), drain=True)
    current = {name: rows_of(streaming.read_current(spark, str(tmp_path / name), ["sensor_id"]), "sensor_id", "seq")
               for name in ("latest", "first", "last")}
    assert current == {"latest": [(1, 0), (2, 2)], "first": [(1, 0), (2, 2)], "last": [(1, 1), (2, 2)]}


def test_running_mean_on_a_stream(spark, feed, tmp_path):
    fed = feed("in", schemas.MEASUREMENT).add(reading(10, 1, 5.0)).add(reading(20, 1, 15.0))
    streaming.write_updates(ops.running_mean(fed.stream()), str(tmp_path / "t"), str(tmp_path / "c"), drain=True)
    assert rows_of(streaming.read_current(spark, str(tmp_path / "t"), ["sensor_id"])) == [(1, 20, 10.0)]
    with pytest.raises(ValueError):
        ops.running_mean(fed.stream(), compat=True)


def test_processing_time_windows(spark, feed, tmp_path):
    fed = feed("in", schemas.MEASUREMENT).add(reading(10, 1, 5.0), reading(20, 1, 15.0))
    means = ops.sliding_mean(with_processing_time(fed.stream()), time="pt")
    streaming.write_updates(means, str(tmp_path / "t"), str(tmp_path / "c"), drain=True)
    rows = spark.read.parquet(str(tmp_path / "t")).collect()
    assert [r.mean for r in rows] == [10.0, 10.0]
    assert {ms_of(r.window_end) - ms_of(r.window_start) for r in rows} == {10_000}


def _pairs(readings, states):
    return ops.state_at_reading(with_event_time(readings.stream()), with_event_time(states.stream()))


def _joined_feeds(feed):
    rng = random.Random(8)
    readings, states = feed("readings", schemas.MEASUREMENT), feed("states", schemas.VALVE_STATE)
    kinds = ["OPEN", "CLOSE", "OBSTRUCTED"]
    for batch in range(4):
        base = batch * 30_000
        readings.add(*[reading(base + rng.randrange(600), rng.randrange(2), rng.choice([10, 520, 590]), i)
                       for i in range(60)])
        states.add(*[(base + rng.randrange(600), rng.randrange(2), rng.choice(kinds), i) for i in range(60)])
    return readings, states


def test_join_replayed_equals_the_table_and_forgets_old_rows(spark, feed, tmp_path):
    readings, states = _joined_feeds(feed)
    query, out = drained(spark, _pairs(readings, states), tmp_path)
    expected = rows_of(ops.state_at_reading(readings.table(), states.table()))
    assert rows_of(out) == expected != []
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal < 4 * 120


def test_side_outputs_go_to_their_own_tables(spark, feed, tmp_path):
    readings, states = _joined_feeds(feed)
    streaming.write_routed(ops.tag_alerts(_pairs(readings, states)), ops.route_alerts, str(tmp_path / "t"),
                           str(tmp_path / "c"), drain=True)
    expected = ops.route_alerts(ops.tag_alerts(ops.state_at_reading(readings.table(), states.table())))
    for name, rows in expected.items():
        assert rows_of(spark.read.parquet(str(tmp_path / "t" / name)).drop("batch_id")) == rows_of(rows) != []


def test_two_stream_windows_replayed_equal_the_table(spark, feed, tmp_path):
    readings, states = _joined_feeds(feed)
    stacked = ops.stack_observations(readings.table(), states.table())
    tagged = ops.tag_readings(readings.table(), readings.table())
    expected = rows_of(ops.valve_performance(stacked)), rows_of(ops.sensor_deviation(tagged, tolerance=-1.0))
    readings.add(reading(10_000_000, 99, 0.0))
    states.add((10_000_000, 98, "OPEN", 0))
    _, shares = drained(spark, ops.valve_performance(with_event_time(
        ops.stack_observations(readings.stream(), states.stream()))), tmp_path, "shares")
    _, alerts = drained(spark, ops.sensor_deviation(with_event_time(
        ops.tag_readings(readings.stream(), readings.stream())), tolerance=-1.0), tmp_path, "alerts")
    assert [r[:-1] for r in rows_of(shares)] == [r[:-1] for r in expected[0]] != []
    assert rows_of(alerts, "ts", "sensor_id") == sorted((r[0], r[1]) for r in expected[1])


OBSERVED = schemas.OBSERVED_STATE


def _observed_batches(seed, batches=3, n=50):
    """Rows with small disorder inside the watermark delay, split by arrival."""
    rng = random.Random(seed)
    states = ["OPEN", "CLOSE", "OBSTRUCTED", "OBSTRUCTED", "CLOSE"]
    rows = [(1_000 * i - rng.randrange(1_000), rng.choice([1, 1, 2]), rng.choice([20.0, 30.0, 40.0, 600.0]),
             rng.choice(states), i) for i in range(1, batches * n + 1)]
    return [rows[k * n:(k + 1) * n] for k in range(batches)]


@pytest.mark.parametrize("after_match", ["all", "first"])
def test_pattern_on_a_stream(spark, feed, tmp_path, after_match):
    batches = _observed_batches(9)
    rows = [r for batch in batches for r in batch]
    fed = feed("in", OBSERVED)
    for batch in batches[:2]:
        fed.add(*batch)
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")

    def run():
        streaming.match_patterns_in_batches(
            fed.stream(), path, checkpoint, min_times=3, after_match=after_match, rows_per_slice=15, drain=True)
        return streaming.read_pattern_alerts(spark, path)

    run()
    for batch in batches[2:]:  # restart on the same checkpoint
        fed.add(*batch)
    fed.add((10_000_000, 99, 0.0, "OPEN", 10_000))
    assert rows_of(run()) == brute_force(rows, 3, first_only=after_match == "first") != []


def test_late_row_is_dropped_by_the_table_form(spark, feed, tmp_path):
    fed = feed("in", OBSERVED)
    fed.add(*[(1_000 * i, 1, 20.0, s, i) for i, s in enumerate(["OPEN", "CLOSE", "CLOSE"])])
    fed.add((60_000, 1, 20.0, "OPEN", 3)).add((1_500, 1, 20.0, "OPEN", 4)).add((90_000, 1, 600.0, "OPEN", 5))
    fed.add((200_000, 9, 0.0, "OPEN", 6))
    streaming.match_patterns_in_batches(
        fed.stream(), str(tmp_path / "t"), str(tmp_path / "c"), min_times=2, drain=True)
    assert rows_of(streaming.read_pattern_alerts(spark, str(tmp_path / "t")), "units", "ts") == [
        ("MALFUNCTIONING NOT OPENING TIMES 2", 90_000)]


def _report(ms, vehicle, value, seq):
    return (ms, vehicle, f"owner {vehicle}", value, seq)


def _alert(ms, sensor, value, seq):
    return (ms, sensor, "CELSIUS", float(value), 2, seq)


def test_causes_on_a_stream_with_restart(spark, feed, tmp_path):
    rng = random.Random(10)
    reports, alerts = feed("reports", schemas.CUSTOMER_REPORT), feed("alerts", schemas.SENSOR_ALERT)
    raw_reports, raw_alerts = [], []
    kinds = ["BROKEN_DOWN", "DISSATISFIED", "SATISFIED"]

    def add(batch):
        base = batch * 5 * HOUR
        some = [(base + rng.randrange(5 * HOUR), rng.choice([1, 1, 2]), rng.choice(kinds), 100 * batch + i) for i in range(30)]
        more = [(base + rng.randrange(5 * HOUR), rng.choice([100, 110, 250]), 100 * batch + i, 100 * batch + i)
                for i in range(30)]
        reports.add(*[_report(*r) for r in some])
        alerts.add(*[_alert(*a) for a in more])
        raw_reports.extend(some)
        raw_alerts.extend(more)

    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")

    def run():
        streaming.match_causes_in_batches(
            reports.stream(), alerts.stream(), path, checkpoint, rows_per_slice=20, drain=True)
        return (streaming.read_causes(spark, path),
                streaming.read_causes_state(spark, path).select("vehicle_id", F.col("alert.value").alias("alert_value")))

    add(0), add(1)
    run()
    add(2), add(3)
    pairs, state = run()
    assert rows_of(pairs, *PAIR) == _loop(raw_reports, [(a[0], a[1], float(a[2]), a[3]) for a in raw_alerts], 2 * HOUR)
    newest = {}
    for a in sorted(raw_alerts, key=lambda a: (a[0], a[3])):
        newest[a[1] // 100] = float(a[2])
    assert dict(rows_of(state, "vehicle_id", "alert_value")) == newest


def test_later_batches_follow_arrival(spark, feed, tmp_path):
    reports = feed("reports", schemas.CUSTOMER_REPORT).add(_report(5_000, 1, "BROKEN_DOWN", 0))
    alerts = feed("alerts", schemas.SENSOR_ALERT).add(_alert(1_000, 900, 1.0, 0)).add(_alert(1_000, 150, 2.0, 1))
    path = str(tmp_path / "t")
    streaming.match_causes_in_batches(reports.stream(), alerts.stream(), path, str(tmp_path / "c"), drain=True)
    assert rows_of(streaming.read_causes(spark, path), *PAIR) == [(5_000, "BROKEN_DOWN", 1_000, 2.0)]


@pytest.mark.parametrize("records", [500, 10_000])
def test_busy_vehicle_in_one_micro_batch(spark, feed, tmp_path, records):
    """One vehicle, a complaint and an alert in turn: the order holds for any size of the transfer to Python."""
    count = 20_000
    reports = feed("reports", schemas.CUSTOMER_REPORT).add(
        *[_report(2_000 * k, 1, "BROKEN_DOWN", 2 * k) for k in range(count // 2)])
    alerts = feed("alerts", schemas.SENSOR_ALERT).add(
        *[_alert(2_000 * k + 1_000, 150, k, 2 * k + 1) for k in range(count // 2)])
    expected = rows_of(ops.potential_causes(reports.table(), alerts.table()))
    assert len(expected) == count - 1
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        streaming.match_causes_in_batches(
            reports.stream(), alerts.stream(), str(tmp_path / "t"), str(tmp_path / "c"), rows_per_slice=3_000, drain=True)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert rows_of(streaming.read_causes(spark, str(tmp_path / "t"))) == expected
    state = streaming.read_causes_state(spark, str(tmp_path / "t")).select("report.seq", "alert.seq").first()
    assert tuple(state) == (count - 2, count - 1)


def test_empty_state_can_be_read(spark, feed, tmp_path):
    reports = feed("reports", schemas.CUSTOMER_REPORT).add(_report(5_000, 1, "SATISFIED", 0))
    alerts = feed("alerts", schemas.SENSOR_ALERT).add(_alert(1_000, 900, 1.0, 0))
    streaming.match_causes_in_batches(
        reports.stream(), alerts.stream().where("false"), str(tmp_path / "t"), str(tmp_path / "c"), drain=True)
    assert rows_of(streaming.read_causes_state(spark, str(tmp_path / "t"))) == []


def test_chain_as_one_stream_equals_the_tables(spark, feed, tmp_path):
    """Complaints and patterns over several micro-batches with a restart, in event-time order."""
    rng = random.Random(12)
    observed, reports = feed("observed", OBSERVED), feed("reports", schemas.CUSTOMER_REPORT)
    batches = _observed_batches(9, batches=4)
    kinds = ["BROKEN_DOWN", "SATISFIED", "DISSATISFIED"]
    told = [[_report(1_000 * i - rng.randrange(900), 0, rng.choice(kinds), i) for i in range(50 * b + 1, 50 * b + 51)]
            for b in range(4)]
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")

    def run():
        streaming.match_complaints_with_patterns(
            reports.stream(), observed.stream(), path, checkpoint, min_times=3, rows_per_slice=15, drain=True)

    for k in range(2):
        observed.add(*batches[k]), reports.add(*told[k])
    run()
    for k in range(2, 4):
        observed.add(*batches[k]), reports.add(*told[k])
    whole = ops.potential_causes(reports.table(), ops.dangerous_valves(observed.table(), min_times=3))
    expected = rows_of(whole)
    observed.add((10_000_000, 99_999, 0.0, "OPEN", 10_000))
    run()
    assert rows_of(streaming.read_causes(spark, path)) == expected != []


@pytest.mark.parametrize("whole_chain", [True, False])
def test_chain_from_readings_keeps_no_rows_in_a_join_of_streams(spark, feed, tmp_path, whole_chain):
    """Readings are joined with states as tables, also across micro-batches and a restart."""
    from fleetlens import jobs

    rng, seq = random.Random(4), 0
    readings, states = feed("readings", schemas.MEASUREMENT), feed("states", schemas.VALVE_STATE)
    reports = feed("reports", schemas.CUSTOMER_REPORT)
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    sizes, pattern = {"size": "20 seconds", "within": "6 seconds"}, {"min_times": 2, "heat_above": 50.0}

    def drain():
        if whole_chain:
            return jobs.customer_service_stream(
                reports.stream(), readings.stream(), states.stream(), path, checkpoint, True, pairs=sizes,
                pattern=pattern)
        return jobs.pattern_alerts_stream(
            readings.stream(), states.stream(), path, checkpoint, True, sizes, pattern)

    for n in range(3):
        measured, seen, told = [], [], []
        for k in range(120):
            seq += 1
            ms, sensor = 30_000 * n + 250 * k + rng.randrange(0, 3_000, 250), rng.choice([1, 1, 2])
            measured.append(reading(ms, sensor, rng.choice([10, 20, 70]), seq))
            seen.append((ms - rng.randrange(600), sensor, rng.choice(["OPEN", "CLOSE", "OBSTRUCTED"]), seq))
            told.append(_report(ms + 100, 0, rng.choice(["BROKEN_DOWN", "SATISFIED"]), seq))
        readings.add(*measured), states.add(*seen), reports.add(*told)
        if n != 1:
            drain()
    tables = readings.table(), states.table()
    if whole_chain:
        expected = rows_of(jobs.customer_service(reports.table(), *tables, pairs=sizes, pattern=pattern))
    else:
        expected = rows_of(jobs.pattern_alerts(*tables, sizes, pattern))
    readings.add(reading(10_000_000, 99_999, 0.0, 10_000))
    query = drain()
    found = streaming.read_causes(spark, path) if whole_chain else streaming.read_pattern_alerts(spark, path)
    assert rows_of(found) == expected != []
    assert list(query.lastProgress.stateOperators) == []
    kept = streaming.files.names(spark, f"{path}/states")
    assert len([name for name in kept if name.startswith("batch_id=")]) <= 2


def test_latest_table_is_kept_and_compacted(spark, feed, tmp_path):
    reports = feed("reports", schemas.CUSTOMER_REPORT).add(_report(5_000, 1, "BROKEN_DOWN", 0))
    reports.add(_report(6_000, 1, "DISSATISFIED", 1), _report(1, 2, "BROKEN_DOWN", 2))
    alerts = feed("alerts", schemas.SENSOR_ALERT).add(_alert(6_000, 150, 2.0, 1))
    streaming.append_latest(
        ops.latest_per_vehicle(reports.stream(), alerts.stream()), str(tmp_path / "t"), str(tmp_path / "c"), drain=True)
    streaming.compact_latest(spark, str(tmp_path / "t"), str(tmp_path / "compact"))
    for name in ("t", "compact"):
        table = streaming.read_latest(spark, str(tmp_path / name))
        assert table.count() == 2
        assert ops.lookup(table, 1, "complaint").value == "DISSATISFIED"
        assert ops.lookup(table, 1, "alert").sensor_id == 150


def test_interval_join_in_sql_on_streams(spark, feed, tmp_path):
    reports = feed("reports", schemas.CUSTOMER_REPORT).add(_report(10 * HOUR, 1, "BROKEN_DOWN", 0))
    alerts = feed("alerts", schemas.SENSOR_ALERT).add(
        _alert(9 * HOUR, 199, 1.0, 0), _alert(11 * HOUR, 199, 2.0, 1), _alert(11 * HOUR + 1, 199, 3.0, 2))
    ops.publish_reports(reports.stream())
    ops.publish_alerts(alerts.stream())
    _, out = drained(spark, ops.potential_causes_sql(spark), tmp_path)
    assert rows_of(out, "alert_value") == [(1.0,), (2.0,)]


def test_print_sinks(spark, feed, tmp_path, capfd):
    fed = feed("in", schemas.MEASUREMENT).add(reading(1, 4711, 2.0))
    streaming.print_table(fed.table())
    streaming.print_stream(ops.to_fahrenheit(fed.stream()), str(tmp_path / "c"), drain=True)
    assert "4711" in capfd.readouterr().out
