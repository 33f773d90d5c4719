"""Starts, complaints and alerts that are forgotten after a time, and state that stays small."""

import os
import random

import pytest

from conftest import rows_of
from fleetlens import operators as ops, schemas, streaming
from fleetlens.streaming import batches as batch_forms
from test_causes import HOUR
from test_patterns import CLOSURE, NORMAL
from test_streaming import OBSERVED, Feed, _alert, _observed_batches, _report, feed  # noqa: F401  (feed is a fixture)


def forgetful(rows, min_times, ttl, first_only, heat=500.0):
    """(ms, units, seq of the start) of the pattern where heat must come within ``ttl`` of the start."""
    out = {}
    for sensor in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == sensor), key=lambda r: (r[0], r[4]))
        for i, row in enumerate(mine):
            if row[3] not in NORMAL:
                continue
            end = i + 1
            while end < len(mine) and mine[end][3] in CLOSURE:
                end += 1
            hot = next((r for r in mine[end:] if r[2] > heat), None)
            if end - i - 1 >= min_times and hot is not None and hot[0] - row[0] < ttl:
                out.setdefault((sensor, end) if first_only else (sensor, i), (
                    hot[0], f"MALFUNCTIONING NOT OPENING TIMES {end - i - 1}", row[4]))
    return sorted(out.values())


@pytest.mark.parametrize("after_match", ["all", "first"])
@pytest.mark.parametrize("ttl", [6_000, 14_000])
def test_starts_are_forgotten(spark, feed, tmp_path, after_match, ttl):  # noqa: F811
    batches = _observed_batches(21, batches=4, n=60)
    rows = [r for batch in batches for r in batch]
    expected = forgetful(rows, 2, ttl, after_match == "first")
    assert 0 < len(expected) < len(forgetful(rows, 2, 10**9, after_match == "first"))
    fed = feed("in", OBSERVED)
    for batch in batches:
        fed.add(*batch)
    names = ("ts", "units", "seq")
    for slice_rows in (4_000_000, 13):
        assert rows_of(ops.dangerous_valves(
            fed.table(), min_times=2, after_match=after_match, ttl=f"{ttl} milliseconds",
            rows_per_slice=slice_rows), *names) == expected
    fed.add((10_000_000, 99, 0.0, "OPEN", 10_000))
    path = str(tmp_path / "t")
    streaming.match_patterns_in_batches(
        fed.stream(), path, str(tmp_path / "c"), min_times=2, after_match=after_match, ttl=f"{ttl} milliseconds", drain=True)
    assert rows_of(streaming.read_pattern_alerts(spark, path), *names) == expected


def test_pattern_state_stays_small(spark, feed, tmp_path):  # noqa: F811
    """Every micro-batch leaves a start that never meets heat."""
    fed, path = feed("in", OBSERVED), str(tmp_path / "t")
    for n in range(12):
        fed.add((n * 10_000, n, 1.0, "OPEN", 3 * n), (n * 10_000 + 1, n, 1.0, "CLOSE", 3 * n + 1),
                (n * 10_000 + 2, n, 1.0, "OPEN", 3 * n + 2))
    streaming.match_patterns_in_batches(
        fed.stream(), path, str(tmp_path / "c"), min_times=1, ttl="25 seconds", drain=True)
    newest = max(int(name.split("=")[1]) for name in os.listdir(f"{path}/pending") if name.startswith("batch_id="))
    assert spark.read.parquet(f"{path}/pending/batch_id={newest}").count() <= 8
    for table in ("pending", "held", "clock"):  # what no replay needs is gone
        assert sorted(name for name in os.listdir(f"{path}/{table}") if name.startswith("batch_id=")) == sorted(
            f"batch_id={n}" for n in (newest - 1, newest))


def test_causes_are_forgotten_and_state_stays_small(spark, feed, tmp_path, monkeypatch):  # noqa: F811
    monkeypatch.setattr(batch_forms, "FULL_EVERY", 4)
    rng = random.Random(3)
    reports, alerts = feed("reports", schemas.CUSTOMER_REPORT), feed("alerts", schemas.SENSOR_ALERT)
    path, checkpoint, seq = str(tmp_path / "t"), str(tmp_path / "c"), 0
    for n in range(11):
        told, raised = [], []
        for _ in range(6):
            seq += 1
            told.append(_report(n * HOUR + rng.randrange(HOUR), n // 2, "BROKEN_DOWN", seq))
            raised.append(_alert(n * HOUR + rng.randrange(HOUR), 100 * (n // 2) + 5, seq, seq))
        reports.add(*told), alerts.add(*raised)
    streaming.match_causes_in_batches(
        reports.stream(), alerts.stream(), path, checkpoint, ttl="30 minutes", drain=True)
    whole = ops.potential_causes(reports.table(), alerts.table(), within="30 minutes")
    assert rows_of(streaming.read_causes(spark, path)) == rows_of(whole) != []
    state = streaming.read_causes_state(spark, path).where("report IS NOT NULL OR alert IS NOT NULL")
    assert {r.vehicle_id for r in state.collect()} <= {4, 5}
    kept = [name for name in os.listdir(f"{path}/state") if name.startswith("batch_id=")]
    assert len(kept) <= 2 * 4


def test_ttl_of_the_whole_chain(spark, feed, tmp_path):  # noqa: F811
    batches = _observed_batches(9, batches=3)
    rng = random.Random(12)
    observed, reports = feed("observed", OBSERVED), feed("reports", schemas.CUSTOMER_REPORT)
    for b, batch in enumerate(batches):
        observed.add(*batch)
        reports.add(*[_report(1_000 * i - rng.randrange(900), 0, "BROKEN_DOWN", i) for i in range(50 * b + 1, 50 * b + 51)])
    alerts = ops.dangerous_valves(observed.table(), min_times=2, ttl="9 seconds")
    expected = rows_of(ops.potential_causes(reports.table(), alerts, within="9 seconds"))
    observed.add((10_000_000, 99_999, 0.0, "OPEN", 10_000))
    path = str(tmp_path / "t")
    streaming.match_complaints_with_patterns(
        reports.stream(), observed.stream(), path, str(tmp_path / "c"), min_times=2, ttl="9 seconds", drain=True)
    assert rows_of(streaming.read_causes(spark, path)) == expected != []
