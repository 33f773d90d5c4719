import random

import pytest

from conftest import rows_of
from fleetlens import operators as ops

HOUR = 3_600_000
PAIR = ("report_ts", "report_value", "alert_ts", "alert_value")


def test_both_directions_and_satisfied_in_between(tables):
    reports = tables.reports((1000, 1, "BROKEN_DOWN"), (2000, 1, "SATISFIED"))
    alerts = tables.alerts((3000, 199, 600.0))
    assert rows_of(ops.potential_causes(reports, alerts), *PAIR) == [(1000, "BROKEN_DOWN", 3000, 600.0)]
    later = tables.reports((4000, 1, "DISSATISFIED"))
    assert rows_of(ops.potential_causes(later, alerts), *PAIR) == [(4000, "DISSATISFIED", 3000, 600.0)]


def test_band_is_strict(tables):
    reports = tables.reports((0, 1, "BROKEN_DOWN"), (0, 2, "BROKEN_DOWN"))
    alerts = tables.alerts((2 * HOUR, 100, 1.0), (2 * HOUR - 1, 200, 2.0))
    assert rows_of(ops.potential_causes(reports, alerts), "vehicle_id") == [(2,)]


def test_equal_times_report_comes_first(tables):
    reports = tables.reports((5, 1, "BROKEN_DOWN", 9))
    alerts = tables.alerts((5, 100, 1.0, 0))
    assert len(rows_of(ops.potential_causes(reports, alerts))) == 1


def test_other_vehicles_do_not_match(tables):
    assert rows_of(ops.potential_causes(
        tables.reports((5, 1, "BROKEN_DOWN")), tables.alerts((6, 200, 1.0)))) == []


def _loop(reports, alerts, within, per_vehicle=100):
    events = [(r[0], 0, r[3], "r", r) for r in reports if r[2] != "SATISFIED"]
    events += [(a[0], 1, a[3], "a", a) for a in alerts]
    state, out = {}, []
    for _, _, _, kind, row in sorted(events, key=lambda e: e[:3]):
        vehicle = row[1] if kind == "r" else row[1] // per_vehicle
        last = state.setdefault(vehicle, {})
        last[kind] = row
        if "r" in last and "a" in last and abs(last["r"][0] - last["a"][0]) < within:
            out.append((last["r"][0], last["r"][2], last["a"][0], last["a"][2]))
    return sorted(out)


@pytest.mark.parametrize("rows_per_slice", [10_000, 40, 5])
@pytest.mark.parametrize("span", [10 * HOUR, 6])
def test_any_slicing_matches_a_plain_loop(tables, rows_per_slice, span):
    rng = random.Random(5)
    kinds = ["BROKEN_DOWN", "DISSATISFIED", "SATISFIED"]
    reports = [(rng.randrange(span), rng.choice([1, 1, 2]), rng.choice(kinds), i) for i in range(120)]
    alerts = [(rng.randrange(span), rng.choice([100, 110, 250]), float(i), i) for i in range(120)]
    out = ops.potential_causes(
        tables.reports(*reports), tables.alerts(*alerts), rows_per_slice=rows_per_slice)
    assert rows_of(out, *PAIR) == _loop(reports, alerts, 2 * HOUR)


def test_latest_per_vehicle_and_lookup(tables):
    reports = tables.reports((1, 1, "BROKEN_DOWN"), (5, 1, "SATISFIED"), (3, 1, "DISSATISFIED"), (1, 2, "BROKEN_DOWN"))
    alerts = tables.alerts((9, 150, 1.0), (8, 160, 2.0))
    latest = ops.latest_per_vehicle(reports, alerts)
    assert ops.lookup(latest, 1, "complaint").value == "DISSATISFIED"
    assert ops.lookup(latest, 1, "alert").sensor_id == 150
    assert ops.lookup(latest, 2, "alert") is None and ops.lookup(latest, 77, "alert") is None
    with pytest.raises(ValueError):
        ops.lookup(latest, 1, "owner")


def test_sql_band_is_inclusive_and_divides_whole(spark, tables):
    ops.publish_reports(tables.reports(
        (10 * HOUR, 1, "BROKEN_DOWN"), (10 * HOUR, 1, "SATISFIED"), (10 * HOUR, 2, "DISSATISFIED")))
    ops.publish_alerts(tables.alerts(
        (9 * HOUR, 199, 1.0), (11 * HOUR, 199, 2.0), (9 * HOUR - 1, 199, 3.0), (11 * HOUR + 1, 199, 4.0),
        (10 * HOUR, 300, 5.0)))
    assert rows_of(ops.potential_causes_sql(spark), "vehicle_id", "report_value", "alert_value") == [
        (1, "BROKEN_DOWN", 1.0), (1, "BROKEN_DOWN", 2.0)]


def test_sql_matches_every_pair_in_the_band(spark, tables):
    rng = random.Random(6)
    reports = [(rng.randrange(40 * HOUR), rng.choice([0, 1]), "BROKEN_DOWN") for _ in range(80)]
    alerts = [(rng.randrange(40 * HOUR), rng.choice([5, 150]), float(i)) for i in range(80)]
    ops.publish_reports(tables.reports(*reports))
    ops.publish_alerts(tables.alerts(*alerts))
    expected = sorted((r[1], float(r[0]), a[2]) for r in reports for a in alerts
                      if r[1] == a[1] // 100 and abs(r[0] - a[0]) <= HOUR)
    assert rows_of(ops.potential_causes_sql(spark), "vehicle_id", "report_time", "alert_value") == expected
