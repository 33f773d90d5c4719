import random

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from fleetlens import operators as ops
from fleetlens.schemas import OWNER, SENSOR_REFERENCE


def test_sliding_mean_on_a_window_edge(tables):
    out = ops.sliding_mean(tables.measurements((5_000, 1, 10.0), (9_999, 1, 20.0), (10_000, 1, 60.0)))
    assert rows_of(out, "window_start", "window_end", "ts", "mean") == [
        (0, 10_000, 9_999, 15.0), (5_000, 15_000, 10_000, 30.0), (10_000, 20_000, 10_000, 60.0)]


def test_sensor_deviation_limits_and_one_sided_windows(tables):
    tagged = tables.tagged(
        ("PRIMARY", 1, 1, 50.0), ("SECONDARY", 2, 1, 30.0),            # exactly 20
        ("PRIMARY", 10_001, 1, 50.1), ("SECONDARY", 10_002, 1, 30.0),  # above
        ("PRIMARY", 20_001, 1, 500.0), ("SECONDARY", 30_001, 1, 500.0))
    out = ops.sensor_deviation(tagged)
    (row,) = rows_of(out)
    assert row[:3] == (20_000, 1, "SENSOR DIFF CELSIUS") and row[3] == pytest.approx(20.1) and row[4] == 2


def test_deviation_compat_compares_the_mean_of_all(tables):
    tagged = tables.tagged(("PRIMARY", 1, 1, 100.0), ("SECONDARY", 2, 1, 70.0))
    assert rows_of(ops.sensor_deviation(tagged), "value") == [(30.0,)]
    assert rows_of(ops.sensor_deviation(tagged, compat=True)) == []
    only = tables.tagged(("SECONDARY", 2, 1, 70.0))
    assert rows_of(ops.sensor_deviation(only, compat=True, tolerance=-1.0), "value") == [(0.0,)]


def test_valve_performance_needs_both_sides(tables):
    readings = tables.measurements((1, 1, 10.0), (2, 1, 30.0), (25_001, 1, 5.0))
    states = tables.states((3, 1, "OPEN"), (4, 1, "OPEN"), (5, 1, "CLOSE"), (6, 1, "OBSTRUCTED"), (50_001, 1, "OPEN"))
    out = ops.valve_performance(ops.stack_observations(readings, states))
    assert rows_of(out) == [(1, 0, 25_000, 0.5, 0.25, 0.25, 20.0)]


def test_edit_bytes(spark, tables):
    edits = tables.measurements((1, 1, 5.0), (4_999, 1, -8.0), (5_000, 1, 1.0)).select(
        "ts", F.lit("ann").alias("user"), F.col("value").cast("long").alias("byte_diff"), "seq")
    assert rows_of(ops.edit_bytes_per_user(edits), "user", "bytes", "window_start") == [("ann", -3, 0), ("ann", 1, 5_000)]


@pytest.mark.parametrize("gap, found", [(0, 0), (1, 1), (19, 1), (20, 0)])
def test_pairs_by_gap(tables, gap, found):
    out = ops.state_at_reading(tables.measurements((100 + gap, 1, 1.0)), tables.states((100, 1, "OPEN")))
    assert len(rows_of(out)) == found


def test_pairs_across_a_window_edge_are_lost(tables):
    out = ops.state_at_reading(tables.measurements((200, 1, 1.0)), tables.states((199, 1, "OPEN")))
    assert rows_of(out) == []


@pytest.mark.parametrize("size, within", [(200, 20), (2_000, 200), (50, 30), (7, 10)])
def test_pairs_match_every_combination(tables, size, within):
    rng = random.Random(size)
    readings = [(rng.randrange(-500, 3_000), rng.randrange(2), float(i)) for i in range(150)]
    states = [(rng.randrange(-500, 3_000), rng.randrange(2), "OPEN") for _ in range(150)]
    expected = sorted((m[0], s[0], i, j) for i, m in enumerate(readings) for j, s in enumerate(states)
                      if m[1] == s[1] and m[0] // size == s[0] // size and 0 < m[0] - s[0] < within)
    out = ops.state_at_reading(tables.measurements(*readings), tables.states(*states),
                               f"{size} milliseconds", f"{within} milliseconds")
    assert rows_of(out, "ts", "state_ts", "seq", "state_seq") == expected


def _pairs(tables, *rows):
    return tables.observed(*rows).select(
        "ts", "sensor_id", F.lit("CELSIUS").alias("units"), "value", "seq",
        F.col("ts").alias("state_ts"), "state", F.col("seq").alias("state_seq"))


PAIRS = [(1, 1, 500.0, "OPEN"), (2, 1, 500.1, "OPEN"), (3, 1, 550.0, "CLOSE"), (4, 1, 550.1, "CLOSE"),
         (5, 1, 10.0, "OBSTRUCTED")]
HOT, BLOCKED = "MALFUNCTIONING TEMPERATURE", "MALFUNCTIONING OBSTRUCTED"


def test_state_alerts(tables):
    out = ops.state_alerts(_pairs(tables, *PAIRS))
    assert rows_of(out, "ts", "units", "level") == [(2, HOT, 2), (4, HOT, 2), (5, BLOCKED, 3)]


def test_state_alerts_compat_repeats_temperature_alerts_as_obstructions(tables):
    pairs = _pairs(tables, *PAIRS)
    out = rows_of(ops.state_alerts(pairs, compat=True), "ts", "units", "level")
    assert out == [(2, BLOCKED, 3), (2, HOT, 2), (4, BLOCKED, 3), (4, HOT, 2)]
    routed = ops.route_alerts(ops.tag_alerts(pairs), compat=True)
    assert rows_of(routed["obstructed"], "ts") == [(2,), (4,)]


def test_routing_splits_the_bag(tables):
    routed = ops.route_alerts(ops.tag_alerts(_pairs(tables, *PAIRS)))
    assert rows_of(routed["temperature"], "ts") == [(2,), (4,)]
    assert rows_of(routed["obstructed"], "ts") == [(5,)]


def _activity(tables):
    return ops.vehicle_activity(tables.measurements((1, 100, 1.0), (2, 200, 1.0)), tables.states((3, 300, "OPEN")))


def test_owner_is_null_where_unknown_and_stolen_are_kept(spark, tables):
    owners = spark.createDataFrame([(1, "Ann", True), (2, "Bob", False)], OWNER)
    enriched = ops.with_owner(_activity(tables), owners)
    assert sorted((r.state.vehicle_id, r.owner and r.owner.owner_name) for r in enriched.collect()) == [
        (1, "Ann"), (2, "Bob"), (3, None)]
    assert rows_of(ops.stolen_vehicles(enriched).select("vehicle_id", "ts", "owner.owner_name")) == [(1, 1, "Ann")]


def test_sensor_reference(spark, tables):
    sensors = spark.createDataFrame([(1, 2.0, 3.0, "a", "b")], SENSOR_REFERENCE)
    out = ops.with_sensor_reference(tables.measurements((1, 1, 5.0), (2, 9, 6.0)), sensors)
    assert rows_of(out.select("measurement.sensor_id", "sensor_reference.lat")) == [(1, 3.0), (9, None)]
