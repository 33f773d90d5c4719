import random

import pytest

from conftest import rows_of
from fleetlens import operators as ops


def test_latest_observation_keeps_the_first_of_a_tie(tables):
    df = tables.measurements((10, 1, 5.0), (20, 1, 1.0), (20, 1, 9.0), (15, 2, 7.0))
    assert rows_of(ops.latest_observation(df), "sensor_id", "ts", "value") == [(1, 20, 1.0), (2, 15, 7.0)]


@pytest.mark.parametrize("tie, seq", [("first", 1), ("last", 3)])
def test_max_reading_ties(tables, tie, seq):
    df = tables.measurements((10, 1, 5.0), (20, 1, 9.0), (30, 1, 2.0), (40, 1, 9.0))
    assert rows_of(ops.max_reading(df, tie), "sensor_id", "value", "seq") == [(1, 9.0, seq)]


def test_unknown_tie_rule(tables):
    with pytest.raises(ValueError):
        ops.max_reading(tables.measurements((1, 1, 1.0)), "middle")


def _random_readings(n, sensors, seed):
    rng = random.Random(seed)
    return [(rng.randrange(0, 400), rng.randrange(sensors) if rng.random() < 0.6 else 0, rng.randrange(6), i)
            for i in range(n)]


def _changelog(readings, better):
    best, out = {}, []
    for r in sorted(readings, key=lambda r: r[3]):
        if r[1] not in best or better(r, best[r[1]]):
            best[r[1]] = r
        out.append((r[3], best[r[1]][3]))
    return sorted(out)


@pytest.mark.parametrize("rows_per_slice", [10_000, 40, 7])
@pytest.mark.parametrize("rule, better", [
    ("latest", lambda new, old: new[0] > old[0]),
    ("max_last", lambda new, old: new[2] >= old[2]),
    ("max_first", lambda new, old: new[2] > old[2]),
])
def test_changelog_matches_a_plain_loop(tables, rule, better, rows_per_slice):
    readings = _random_readings(300, 5, 1)
    out = ops.reading_changelog(tables.measurements(*readings), rule, rows_per_slice=rows_per_slice)
    assert rows_of(out, "at_seq", "seq") == _changelog(readings, better)


@pytest.mark.parametrize("rows_per_slice", [10_000, 40, 7])
@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("every", [1, 3])
def test_running_mean_matches_a_plain_loop(tables, compat, every, rows_per_slice):
    readings = _random_readings(300, 5, 2)
    state, expected = {}, []
    for ms, sensor, value, seq in sorted(readings, key=lambda r: r[3]):
        key = None if compat else sensor
        n, total, last = state.get(key, (0, 0.0, 0))
        n, total, last = state[key] = (n + 1, total + value, max(last, ms))
        if n % every == 0:
            expected.append((seq, sensor, last, total / n))
    out = ops.running_mean(tables.measurements(*readings), every, compat, rows_per_slice=rows_per_slice)
    got = rows_of(out)
    assert [g[:3] for g in got] == [e[:3] for e in sorted(expected)]
    assert [g[3] for g in got] == pytest.approx([e[3] for e in sorted(expected)])


def test_compat_mean_is_global_and_labelled_by_the_last_sensor(tables):
    df = tables.measurements((1, 1, 10.0), (2, 2, 20.0), (3, 1, 60.0))
    assert rows_of(ops.running_mean(df, compat=True), "sensor_id", "ts", "mean") == [
        (1, 1, 10.0), (1, 3, 30.0), (2, 2, 15.0)]
    assert rows_of(ops.running_mean(df), "sensor_id", "ts", "mean") == [
        (1, 1, 10.0), (1, 3, 35.0), (2, 2, 20.0)]


def test_only_sensor_is_off_by_default(tables):
    df = tables.measurements((1, 11080, 10.0), (2, 2, 20.0))
    assert len(rows_of(ops.latest_observation(df))) == 2
    assert rows_of(ops.latest_observation(df, sensor_id=11080), "sensor_id") == [(11080,)]
