import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from conftest import rows_of
from fleetlens import operators as ops

NORMAL, CLOSURE = {"OPEN", "CLOSE"}, {"CLOSE", "OBSTRUCTED"}


def brute_force(rows, min_times=5, heat=500.0, first_only=False):
    """(ms, sensor, times, value, seq of the start), straight from the definition."""
    out = []
    for sensor in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == sensor), key=lambda r: (r[0], r[4]))
        for i, row in enumerate(mine):
            if row[3] not in NORMAL:
                continue
            end = i + 1
            while end < len(mine) and mine[end][3] in CLOSURE:
                end += 1
            times = end - i - 1
            hot = next((r for r in mine[end:] if r[2] > heat), None)
            if times >= min_times and hot is not None:
                out.append((sensor, end, times, hot[0], hot[2], row[4]))
    if first_only:
        longest = {}
        for found in out:
            key = found[:2]
            if key not in longest or found[2] > longest[key][2]:
                longest[key] = found
        out = list(longest.values())
    return sorted((ms, sensor, f"MALFUNCTIONING NOT OPENING TIMES {times}", value, 5, seq)
                  for sensor, _, times, ms, value, seq in out)


def _run(tables, rows, **kw):
    return rows_of(ops.dangerous_valves(tables.observed(*rows), **kw))


def _sequence(states, sensor=1, values=None):
    return [(10 * i, sensor, (values or {}).get(i, 20.0), s, i) for i, s in enumerate(states)]


def test_run_of_four_is_too_short(tables):
    assert _run(tables, _sequence(["OPEN", *["OBSTRUCTED"] * 4, "OPEN"], values={5: 600.0})) == []


def test_run_of_five(tables):
    rows = _sequence(["OPEN", *["OBSTRUCTED"] * 5, "OPEN"], values={6: 600.0})
    assert _run(tables, rows) == [(60, 1, "MALFUNCTIONING NOT OPENING TIMES 5", 600.0, 5, 0)]


def test_heat_inside_the_run_does_not_count_and_cold_rows_are_skipped(tables):
    rows = _sequence(["OPEN", *["OBSTRUCTED"] * 5, "OPEN", "OPEN", "OBSTRUCTED"], values={3: 600.0, 8: 510.0})
    assert _run(tables, rows) == [(80, 1, "MALFUNCTIONING NOT OPENING TIMES 5", 510.0, 5, 0)]


def test_no_heat_no_alert_and_heat_is_strict(tables):
    assert _run(tables, _sequence(["OPEN", *["OBSTRUCTED"] * 5, "OPEN"], values={6: 500.0})) == []


def test_closed_row_inside_a_run_is_a_start_too(tables):
    rows = _sequence(["CLOSE", "CLOSE", *["OBSTRUCTED"] * 5, "OPEN"], values={7: 600.0})
    assert [r[2][-1] for r in _run(tables, rows)] == ["5", "6"]
    assert [r[2][-1] for r in _run(tables, rows, after_match="first")] == ["6"]


def test_two_sensors_do_not_mix(tables):
    one = _sequence(["OPEN", *["OBSTRUCTED"] * 5, "OPEN"], sensor=1, values={6: 600.0})
    two = [(ms + 1, 2, v, s, seq + 100) for ms, _, v, s, seq in one]
    assert {r[1] for r in _run(tables, one + two)} == {1, 2}


def test_unknown_after_match(tables):
    with pytest.raises(ValueError):
        ops.dangerous_valves(tables.observed((1, 1, 1.0, "OPEN")), after_match="last")


def _random_rows(n, seed, busy=False):
    rng = random.Random(seed)
    return [(rng.randrange(5) if busy else rng.randrange(3 * n), rng.choice([1, 1, 1, 2]), rng.choice([20.0, 600.0, 30.0, 40.0]),
             rng.choice(["OPEN", "CLOSE", "OBSTRUCTED", "OBSTRUCTED", "CLOSE"]), i) for i in range(n)]


@pytest.mark.parametrize("rows_per_slice", [10_000, 50, 9, 3])
@pytest.mark.parametrize("busy", [False, True])
@pytest.mark.parametrize("after_match", ["all", "first"])
def test_any_slicing_matches_the_definition(tables, rows_per_slice, busy, after_match):
    rows = _random_rows(250, 4, busy)
    assert _run(tables, rows, min_times=3, after_match=after_match, rows_per_slice=rows_per_slice) == brute_force(
        rows, 3, first_only=after_match == "first")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 2), st.sampled_from([20.0, 600.0]),
                          st.sampled_from(["OPEN", "CLOSE", "OBSTRUCTED"])), min_size=1, max_size=40))
def test_hypothesis_slices_of_four(tables, drawn):
    rows = [(*r, i) for i, r in enumerate(drawn)]
    assert _run(tables, rows, min_times=2, rows_per_slice=4) == brute_force(rows, 2)


def loose_brute_force(rows, min_times, heat=500.0):
    """The loose repetition by walking on from every start."""
    out = []
    for sensor in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == sensor), key=lambda r: (r[0], r[4]))
        for i, row in enumerate(mine):
            if row[3] not in NORMAL or i + 1 == len(mine) or mine[i + 1][3] not in CLOSURE:
                continue
            times = 0
            for later in mine[i + 1:]:
                if later[3] in CLOSURE:
                    times += 1
                elif later[2] > heat and times >= min_times:
                    out.append((later[0], sensor, f"MALFUNCTIONING NOT OPENING TIMES {times}", later[2], 5, row[4]))
                    break
    return sorted(out)


@pytest.mark.parametrize("rows_per_slice", [4_000_000, 5, 17])
def test_loose_repetition_equals_a_walk(tables, rows_per_slice):
    rng = random.Random(rows_per_slice)
    rows = [(rng.randrange(400), rng.choice([1, 1, 1, 2]), rng.choice([20.0, 30.0, 600.0, float("nan")]),
             rng.choice(["OPEN", "CLOSE", "OBSTRUCTED"]), i) for i in range(220)]
    for min_times in (1, 3, 6):
        assert _run(tables, rows, min_times=min_times, compat=True, rows_per_slice=rows_per_slice) == loose_brute_force(
            rows, min_times) != []


def test_loose_repetition_by_hand(tables):
    states = ["OPEN", "OBSTRUCTED", "OPEN", "OBSTRUCTED", "OPEN", "CLOSE", "OPEN"]
    rows = _sequence(states, values={2: 600.0, 6: 700.0})
    # from row 0: closures 1, 3, 5, then the heat of row 6; row 2 is hot too early; rows 2 and 4 have fewer closures
    assert _run(tables, rows, min_times=3, compat=True) == [(60, 1, "MALFUNCTIONING NOT OPENING TIMES 3", 700.0, 5, 0)]
    assert _run(tables, rows, min_times=3) == []
    with pytest.raises(ValueError):
        ops.dangerous_valves(tables.observed(*rows), compat=True, after_match="first")
