"""Keyed tables, results per record on streams, late records and live state, across micro-batches and restarts."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import at, ms_of, rows_of
from fleetlens import operators as ops, schemas, streaming
from fleetlens.streaming import KeyedTable
from test_streaming import Feed, feed, reading  # noqa: F401  (feed is a fixture)


def files_below(path):
    return sorted(os.path.join(folder, name) for folder, _, names in os.walk(path) for name in names
                  if name.endswith(".parquet") and not name.startswith("."))


def forget_last_commit(checkpoint):
    """As after a crash between a micro-batch's output and its commit."""
    folder = f"{checkpoint}/commits"
    last = max(int(name) for name in os.listdir(folder) if name.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{folder}/{name}"):
            os.remove(f"{folder}/{name}")


# --- keyed tables ------------------------------------------------------------------------------------

def pairs(spark, rows):
    return spark.createDataFrame(rows, "k long, who string, v long")


def test_keyed_table_equals_a_dictionary(spark, tmp_path):
    rng, table, expected = random.Random(1), KeyedTable(spark, str(tmp_path / "t"), ("k", "who"), 4), {}
    assert table.read() is None
    for n in range(8):
        rows = {(rng.choice([None, *range(12)]), rng.choice(["a", None])): rng.choice([None, rng.randrange(99)])
                for _ in range(rng.choice([0, 1, 9]))}
        table.merge(pairs(spark, [(k, w, v) for (k, w), v in rows.items()]), n)
        older, expected = expected, {**expected, **rows}
        assert {(r.k, r.who): r.v for r in table.read().collect()} == expected
        assert table.read().count() == len(expected)
        if n:
            assert {(r.k, r.who): r.v for r in table.read(n - 1).collect()} == older
            assert table.versions() == [n - 1, n]
    with pytest.raises(ValueError):
        streaming.read_upserts(spark, str(tmp_path / "t"), ["k", "who"], version=2)


def test_keyed_table_takes_a_replay_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ("k", "who"), 2)
    add = lambda names: {name: F.sum(name) for name in names}
    table.merge(pairs(spark, [(1, "a", 5)]), 0, add)
    for _ in range(3):
        table.merge(pairs(spark, [(1, "a", 7), (2, "a", 1)]), 1, add)
    assert rows_of(table.read()) == [(1, "a", 12), (2, "a", 1)]
    os.makedirs(tmp_path / "t" / "rows" / "1-left-by-a-crash")
    table.merge(pairs(spark, [(1, "a", 1)]), 2, add)
    assert rows_of(table.read()) == [(1, "a", 13), (2, "a", 1)]
    assert not (tmp_path / "t" / "rows" / "1-left-by-a-crash").exists()


def test_a_keyed_sink_grows_with_its_keys_only(spark, feed, tmp_path):  # noqa: F811
    fed, path, checkpoint = feed("in", schemas.MEASUREMENT), str(tmp_path / "t"), str(tmp_path / "c")
    sizes = []
    for n in range(12):
        fed.add(*[reading(n * 100 + k, k % 5, n + k, n * 100 + k) for k in range(20)])
        streaming.write_upserts(ops.latest_observation(fed.stream()), path, checkpoint, ["sensor_id"], 4, drain=True)
        sizes.append(len(files_below(path)))
    assert max(sizes[3:]) <= 2 * 4  # two versions of four buckets
    assert rows_of(streaming.read_upserts(spark, path, ["sensor_id"]).select(*schemas.MEASUREMENT.names)) == rows_of(
        ops.latest_observation(fed.table()))
    forget_last_commit(checkpoint)
    streaming.write_upserts(ops.latest_observation(fed.stream()), path, checkpoint, ["sensor_id"], 4, drain=True)
    assert rows_of(streaming.read_upserts(spark, path, ["sensor_id"]).select(*schemas.MEASUREMENT.names)) == rows_of(
        ops.latest_observation(fed.table()))


# --- results per record ------------------------------------------------------------------------------

def busy_feed(fed, batches=3, rows=60, seed=0):
    """A third and more of all rows are of sensor 1."""
    rng, seq = random.Random(seed), 0
    for n in range(batches):
        made = []
        for _ in range(rows):
            made.append(reading(rng.randrange(100_000), rng.choice([1, 1, 2, 3, n + 10]), rng.randrange(4), seq))
            seq += 1
        rng.shuffle(made)
        fed.add(*made)
    return fed


@pytest.mark.parametrize("every, compat, slice_rows", [(1, False, 4_000_000), (3, False, 7), (4, True, 11)])
def test_running_mean_per_record_on_a_stream(spark, feed, tmp_path, every, compat, slice_rows):  # noqa: F811
    fed, path, checkpoint = busy_feed(feed("in", schemas.MEASUREMENT)), str(tmp_path / "t"), str(tmp_path / "c")

    def drain():
        streaming.running_mean_in_batches(fed.stream(), path, checkpoint, every, compat, slice_rows, 3, drain=True)

    drain()
    fed.add(*[reading(5, s, 2.0, 1000 + s) for s in range(5)])
    drain()
    forget_last_commit(checkpoint)
    drain()
    got = rows_of(streaming.read_running_means(spark, path).withColumn("mean", F.round("mean", 9)))
    want = rows_of(ops.running_mean(fed.table(), every, compat).withColumn("mean", F.round("mean", 9)))
    assert got == want != []


@pytest.mark.parametrize("rule, slice_rows", [("latest", 4_000_000), ("max_last", 7), ("max_first", 9)])
def test_changelog_on_a_stream(spark, feed, tmp_path, rule, slice_rows):  # noqa: F811
    fed, path, checkpoint = busy_feed(feed("in", schemas.MEASUREMENT), seed=3), str(tmp_path / "t"), str(tmp_path / "c")

    def drain():
        streaming.changelog_in_batches(fed.stream(), path, checkpoint, rule, slice_rows, 3, drain=True)

    drain()
    fed.add(reading(1, 77, float("nan"), 2000), reading(2, 1, 3.0, 2001))
    drain()
    forget_last_commit(checkpoint)
    drain()
    assert rows_of(streaming.read_changelog(spark, path).where("NOT isnan(value)")) == rows_of(
        ops.reading_changelog(fed.table(), rule).where("NOT isnan(value)")) != []
    assert streaming.read_changelog(spark, path).count() == fed.table().count()
    kind = {"latest": ops.latest_observation, "max_last": lambda m: ops.max_reading(m, "last"),
            "max_first": lambda m: ops.max_reading(m, "first")}[rule]
    names = ["sensor_id", "seq"]
    assert rows_of(streaming.read_winners(spark, path), *names) == rows_of(kind(fed.table()), *names)


# --- windows that several runs add to ----------------------------------------------------------------

def test_windows_take_late_files(spark, feed, tmp_path):  # noqa: F811
    fed, path, checkpoint = feed("in", schemas.MEASUREMENT), str(tmp_path / "t"), str(tmp_path / "c")
    for start in (50_000, 0, 20_000):  # the first file is the newest one
        fed.add(*[reading(start + 700 * k, k % 3, k, k) for k in range(40)])
        streaming.window_totals_in_batches(fed.stream(), path, checkpoint, buckets=3, drain=True)
    assert rows_of(streaming.read_window_means(spark, path)) == rows_of(ops.sliding_mean(fed.table())) != []


def test_processing_time_windows_over_several_micro_batches(spark, feed, tmp_path):  # noqa: F811
    fed, path, checkpoint = feed("in", schemas.MEASUREMENT), str(tmp_path / "t"), str(tmp_path / "c")
    times = iter([1_000, 8_000, 13_000, 999_000])

    def drain():
        streaming.window_totals_in_batches(fed.stream(), path, checkpoint, clock=lambda: at(next(times)), drain=True)

    fed.add(reading(1, 1, 10.0), reading(2, 2, 1.0))
    drain()
    fed.add(reading(3, 1, 20.0)).add(reading(4, 1, 60.0))
    drain()
    forget_last_commit(checkpoint)  # the replay must not ask the clock again
    drain()
    assert rows_of(streaming.read_clock(spark, path)) == [(0, 1_000), (1, 8_000), (2, 13_000)]
    assert rows_of(streaming.read_window_means(spark, path), "sensor_id", "window_start", "window_end", "ts", "mean") == [
        (1, -5_000, 5_000, 1, 10.0), (1, 0, 10_000, 3, 15.0), (1, 5_000, 15_000, 4, 40.0), (1, 10_000, 20_000, 4, 60.0),
        (2, -5_000, 5_000, 2, 1.0), (2, 0, 10_000, 2, 1.0)]
    assert next(times) == 999_000


# --- late records ------------------------------------------------------------------------------------

def slow_late(rows, delay, size, slide):
    seen, late = None, []
    for ms, seq in sorted(rows, key=lambda r: r[1]):
        end = ms if size is None else ms // slide * slide + size
        if seen is not None and end <= seen - delay:
            late.append(seq)
        seen = ms if seen is None else max(seen, ms)
    return sorted(late)


@pytest.mark.parametrize("size, slide", [(None, None), (10_000, 10_000), (10_000, 5_000)])
def test_late_records_equal_a_loop_and_any_cut_of_the_stream(spark, feed, tmp_path, size, slide):  # noqa: F811
    rng, fed = random.Random(8), feed("in", schemas.MEASUREMENT)
    rows = [(k * 400 + rng.randrange(-25_000, 3_000), k) for k in range(150)]
    for start, end in ((0, 1), (1, 80), (80, 150)):
        fed.add(*[reading(ms, 1, 0.0, seq) for ms, seq in rows[start:end]])
    texts = [None if x is None else f"{x} milliseconds" for x in (size, slide)]
    expected = slow_late(rows, 3_500, size, slide)
    for slice_rows in (4_000_000, 16):
        marked = ops.mark_late(fed.table(), "3500 milliseconds", *texts, rows_per_slice=slice_rows)
        assert [r[0] for r in rows_of(marked.where("late"), "seq")] == expected
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    streaming.split_late_in_batches(fed.stream(), path, checkpoint, "3500 milliseconds", *texts, drain=True)
    forget_last_commit(checkpoint)
    streaming.split_late_in_batches(fed.stream(), path, checkpoint, "3500 milliseconds", *texts, drain=True)
    assert [r[0] for r in rows_of(streaming.read_late(spark, path), "seq")] == expected != []
    assert [r[0] for r in rows_of(streaming.read_on_time(spark, path), "seq")] == sorted(
        set(range(150)) - set(expected))


def test_late_records_of_an_empty_table(tables):
    assert ops.mark_late(tables.measurements()).collect() == []
    assert rows_of(ops.mark_late(tables.measurements((5, 1, 1.0))), "late") == [(False,)]


# --- live state --------------------------------------------------------------------------------------

def latest_of(reports, alerts):
    return ops.latest_per_vehicle(reports, alerts)


def plain_latest(df):
    return sorted((r.vehicle_id, r.complaint and r.complaint.seq, r.alert and r.alert.seq) for r in df.collect())


def test_state_of_a_running_query_at_any_micro_batch(spark, feed, tmp_path, tables):  # noqa: F811
    fed = feed("in", schemas.CUSTOMER_REPORT)
    alerts = tables.alerts((1_000, 150, 9.0, 1), (2_000, 150, 9.0, 2), (3_000, 990, 9.0, 3))
    alerts.write.parquet(str(tmp_path / "alerts"))
    live = spark.readStream.schema(schemas.SENSOR_ALERT).parquet(str(tmp_path / "alerts"))
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    query = streaming.append_latest(latest_of(fed.stream(), live), path, checkpoint)
    try:
        expected = []
        for n in range(3):
            fed.add(*[(n * 1_000 + k, k % 4, f"name {k}", "BROKEN_DOWN", n * 10 + k) for k in range(3 + n)])
            query.processAllAvailable()
            expected.append(plain_latest(latest_of(fed.table(), alerts)))
            assert query.isActive
            assert plain_latest(streaming.read_latest_state(spark, checkpoint)) == expected[-1]
            assert plain_latest(streaming.read_latest(spark, path)) == expected[-1]
        last = query.lastProgress["batchId"]
    finally:
        query.stop()
    operators = streaming.state_operators(spark, checkpoint).collect()
    assert [r.operator_name for r in operators] == ["stateStoreSave"] and operators[0].partitions == 4
    states = [plain_latest(streaming.read_latest_state(spark, checkpoint, batch=n)) for n in range(last + 1)]
    assert [s for s in expected if s in states] == expected and states[-1] == expected[-1]
    found = streaming.lookup_state(spark, checkpoint, 1, "alert")
    assert found.seq == 2 and ms_of(found.ts) == 2_000
    assert streaming.lookup_state(spark, checkpoint, 12345, "alert") is None
    with pytest.raises(ValueError):
        streaming.lookup_state(spark, checkpoint, 1, "owner")
    with pytest.raises(ValueError):
        streaming.read_aggregate_state(spark, checkpoint, ["only one"])


def test_running_means_in_state(spark, feed, tmp_path):  # noqa: F811
    fed = feed("in", schemas.MEASUREMENT).add(reading(10, 1, 5.0)).add(reading(20, 1, 15.0), reading(7, 2, 1.0))
    streaming.write_updates(ops.running_mean(fed.stream()), str(tmp_path / "t"), str(tmp_path / "c"), drain=True)
    assert rows_of(streaming.read_running_means_state(spark, str(tmp_path / "c"))) == [(1, 20, 10.0), (2, 7, 1.0)]
    assert rows_of(streaming.read_running_means_state(spark, str(tmp_path / "c"), batch=0)) == [(1, 10, 5.0)]


def test_rows_that_wait_in_a_join(spark, feed, tmp_path):  # noqa: F811
    from fleetlens.sources import with_event_time
    readings, states = feed("r", schemas.MEASUREMENT), feed("s", schemas.VALVE_STATE)
    readings.add(reading(1_050, 1, 9.0, 0), reading(1_060, 2, 9.0, 1))
    states.add((1_045, 1, "OPEN", 0))
    joined = ops.state_at_reading(with_event_time(readings.stream()), with_event_time(states.stream()))
    streaming.write_append(joined, str(tmp_path / "t"), str(tmp_path / "c"), drain=True)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    waiting = [streaming.read_waiting(spark, str(tmp_path / "c"), side) for side in ("left", "right")]
    assert [w.count() for w in waiting] == [2, 2]  # the state waits in both steps that a reading near it may be in
    assert all(any(c.startswith("key_") for c in w.columns) for w in waiting)


def test_utc_clock_reads_back(spark, tmp_path):
    from fleetlens.streaming.running import _noted
    now = dt.datetime(2026, 3, 29, 1, 30, tzinfo=dt.timezone.utc)
    first = _noted(spark, str(tmp_path / "clock"), 0, lambda: now)
    assert _noted(spark, str(tmp_path / "clock"), 0, lambda: at(0)) == first


# --- keyed processor ---------------------------------------------------------------------------------

def far(reports, alerts, ms):
    """Records that end the time of both streams."""
    reports.add((ms, 99_999, "x", "BROKEN_DOWN", 1 << 40)), alerts.add((ms, 9_999_900, "CELSIUS", 1.0, 2, 1 << 40))


def timed_causes(reports, alerts, slot):
    from fleetlens.sources import with_event_time
    return streaming.causes_by_keyed_state(
        with_event_time(reports.stream()), with_event_time(alerts.stream()), slot=slot)


@pytest.mark.parametrize("records, slot", [(10_000, "1 minute"), (50, "7 seconds")])
def test_keyed_processor_over_micro_batches_and_a_restart(spark, feed, tmp_path, records, slot):  # noqa: F811
    rng, seq = random.Random(5), 0
    reports, alerts = feed("r", schemas.CUSTOMER_REPORT), feed("a", schemas.SENSOR_ALERT)
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)

    def drain():
        streaming.write_append(timed_causes(reports, alerts, slot), path, checkpoint, drain=True)

    try:
        for n in range(4):  # vehicle 1 has most rows; times repeat and are out of order by less than the delay
            told, raised = [], []
            for k in range(200):
                seq += 1
                ms = n * 60_000 + 300 * k + rng.randrange(0, 3_000, 500)
                vehicle = rng.choice([1, 1, 1, 2])
                if rng.random() < 0.5:
                    told.append((ms, vehicle, f"owner {seq}", rng.choice(["BROKEN_DOWN", "SATISFIED"]), seq))
                else:
                    raised.append((ms, 100 * vehicle + 5, "CELSIUS", float(seq), 2, seq))
            reports.add(*told), alerts.add(*raised)
            if n == 1:
                drain()
        drain()
        expected = rows_of(ops.potential_causes(reports.table(), alerts.table()))
        far(reports, alerts, 10_000_000)
        drain()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert rows_of(spark.read.parquet(path)) == expected != []
    last = {r.vehicle_id: r.alert.seq for r in ops.latest_per_vehicle(
        reports.table(), alerts.table()).where("vehicle_id < 3").collect()}
    state = streaming.read_processor_state(spark, checkpoint, "alerts")
    assert {r.vehicle_id: r.seq for r in state.collect()} == last
    assert set(streaming.read_processor_state(spark, checkpoint, "complaints").columns) == {
        "vehicle_id", "ts", "seq", "customer_name", "value"}
    with pytest.raises(ValueError):
        streaming.read_processor_state(spark, checkpoint, "waiting")


def test_keyed_processor_with_a_busy_vehicle(spark, feed, tmp_path):  # noqa: F811
    """100,000 rows of one vehicle, a complaint and an alert in turn, over three micro-batches."""
    reports, alerts = feed("r", schemas.CUSTOMER_REPORT), feed("a", schemas.SENSOR_ALERT)
    third = 50_000 // 3
    for n in range(3):
        some = range(n * third, (n + 1) * third)
        reports.add(*[(1_000 + 20 * k, 1, f"owner {k}", "BROKEN_DOWN", 2 * k) for k in some])
        alerts.add(*[(1_010 + 20 * k, 150, "CELSIUS", float(k), 2, 2 * k + 1) for k in some])
    expected = ops.potential_causes(reports.table(), alerts.table()).count()
    far(reports, alerts, 100_000_000)
    streaming.write_append(timed_causes(reports, alerts, "1 minute"), str(tmp_path / "t"), str(tmp_path / "c"), drain=True)
    pairs = spark.read.parquet(str(tmp_path / "t"))
    assert pairs.count() == expected == 2 * 3 * third - 1
    wrong = pairs.where(F.abs(F.unix_millis("report_ts") - F.unix_millis("alert_ts")) > 10).count()
    assert wrong == 0  # every row meets the one right before it


@pytest.mark.parametrize("whole_rows", [10_000, 0, 40])
def test_keyed_processor_has_one_timer_per_vehicle(spark, feed, tmp_path, whole_rows):  # noqa: F811
    """Whatever the number of slots that wait; rows wait as they came, by slot, and in both ways."""
    from fleetlens.sources import with_event_time
    rng = random.Random(3)
    reports, alerts = feed("r", schemas.CUSTOMER_REPORT), feed("a", schemas.SENSOR_ALERT)
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")

    def drain():
        streaming.write_append(streaming.causes_by_keyed_state(
            with_event_time(reports.stream()), with_event_time(alerts.stream()), slot="5 seconds",
            whole_rows=whole_rows), path, checkpoint, drain=True)

    def timers():
        found = spark.read.format("statestore").option("readRegisteredTimers", True).load(checkpoint).select(
            "key.vehicle_id", "expiration_timestamp_ms").collect()
        return sorted((r.vehicle_id, r.expiration_timestamp_ms) for r in found)

    for n in range(2):  # the reports reach far, the alerts of vehicle 3 hold the time back
        seqs = range(1 + 100 * n, 101 + 100 * n)
        reports.add(*[(20_000 + 1_000 * rng.randrange(90), 1 + k % 2, f"owner {k}", "BROKEN_DOWN", k) for k in seqs])
        alerts.add((5_000, 305, "CELSIUS", 1.0, 2, 100 * (n + 1)))
        drain()
    assert [vehicle for vehicle, _ in timers()] == [1, 2, 3]
    alerts.add(*[(20_000 + 1_000 * k, 105 + 100 * (k % 2), "CELSIUS", float(k), 2, 1_000 + k) for k in range(60)])
    drain()  # reads the time that the alerts give
    reports.add((109_000, 1, "a", "BROKEN_DOWN", 500)), alerts.add((78_000, 105, "CELSIUS", 1.0, 2, 2_000))
    drain()  # some slots have ended, others wait on
    assert [vehicle for vehicle, _ in timers()] == [1, 2] and min(ms for _, ms in timers()) > 70_000
    expected = rows_of(ops.potential_causes(reports.table(), alerts.table()))
    far(reports, alerts, 10_000_000)
    drain()
    assert rows_of(spark.read.parquet(path)) == expected != []
    assert {vehicle for vehicle, _ in timers()} == {99_999}
