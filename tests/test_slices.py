import random

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from fleetlens import operators as ops
from fleetlens.plans import Slices, plan_slices


def _sliced(df, rows_per_slice):
    slices = plan_slices(df, rows_per_slice=rows_per_slice)
    return slices, slices.assign(df)


def _check_order(df):
    """Slices grow with (ts, seq): the greatest of a slice is before the least of the next."""
    bounds = df.groupBy("slice").agg(
        F.min(F.struct("ts", "seq")).alias("low"), F.max(F.struct("ts", "seq")).alias("high")
    ).orderBy("slice").collect()
    for before, after in zip(bounds, bounds[1:]):
        assert before.high < after.low
    return len(bounds)


def test_a_small_table_has_one_slice(tables):
    slices, cut = _sliced(tables.measurements((1, 1, 1.0), (2, 1, 1.0)), 100)
    assert slices.single and rows_of(cut.select("slice").distinct()) == [(0,)]


def test_slices_are_balanced_whatever_the_keys(tables):
    rng = random.Random(3)
    rows = [(rng.randrange(1, 10**6), 0 if rng.random() < 0.5 else rng.randrange(100), 1.0) for _ in range(2000)]
    _, cut = _sliced(tables.measurements(*rows), 100)
    assert _check_order(cut) == 20
    assert cut.groupBy("slice").count().agg(F.max("count")).first()[0] <= 200


def test_a_busy_instant_is_cut_by_arrival(tables):
    rows = [(5, 1, 1.0) for _ in range(900)] + [(t, 1, 1.0) for t in range(10, 110)]
    slices, cut = _sliced(tables.measurements(*rows), 100)
    assert slices.busy
    assert _check_order(cut) > 8
    assert cut.groupBy("slice").count().agg(F.max("count")).first()[0] <= 250


def test_explicit_limits(tables):
    df = tables.measurements((1, 1, 1.0), (2, 1, 1.0), (2, 1, 1.0), (3, 1, 1.0))
    cut = Slices((2_000, 3_000), {2_000: (2,)}).assign(df)
    assert rows_of(cut, "seq", "slice") == [(0, 0), (1, 1 << 16), (2, (1 << 16) + 1), (3, 3 << 16)]


@pytest.mark.parametrize("max_slices", [2, 5])
def test_number_of_slices_is_bounded(tables, max_slices):
    rows = [(t, 1, 1.0) for t in range(1, 500)]
    slices = plan_slices(tables.measurements(*rows), [], 1, max_slices)
    assert len(slices.times) < max_slices


def test_only_large_keys_are_sliced(tables):
    rows = [(t, 0 if t % 3 == 0 else t, 1.0) for t in range(1, 901)]
    df = tables.measurements(*rows)
    slices = plan_slices(df, ["sensor_id"], 50)
    assert slices.key == "sensor_id" and slices.listed == (0,)
    groups = slices.assign(df).groupBy("sensor_id", "slice").count()
    assert groups.agg(F.max("count")).first()[0] <= 100
    assert rows_of(groups.where("sensor_id <> 0").select("slice").distinct()) == [(0,)]
    assert plan_slices(df, ["sensor_id"], 300).single


def test_many_large_keys_slice_everything(tables, monkeypatch):
    monkeypatch.setattr("fleetlens.plans.slices.MAX_LISTED_KEYS", 3)
    rows = [(t, t % 5, 1.0) for t in range(1, 501)]
    slices = plan_slices(tables.measurements(*rows), ["sensor_id"], 50)
    assert slices.key is None and len(slices.times) == 9


def _with_nulls(tables, column, seed):
    rng = random.Random(seed)
    rows = [(1_000 * t, rng.choice([1, 1, 1, 2, 3]), rng.choice([20.0, 30.0, 600.0])) for t in range(1, 401)]
    gone = F.col("seq") < 150 if seed % 2 else F.col("seq") % 3 == 0  # a hot NULL, or whole slices of NULLs
    df = tables.measurements(*rows)
    return df.withColumn(column, F.when(~gone, F.col(column)))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("column", ["sensor_id", "value", "units"])
def test_slicing_changes_nothing_where_there_are_nulls(tables, column, seed):
    df = _with_nulls(tables, column, seed)
    states = F.when(F.col("seq") % 4 == 0, "OPEN").otherwise("CLOSE")
    observed = df.select("ts", "sensor_id", "value", states.alias("state"), "seq")
    alerts = df.withColumn("level", F.lit(2))
    reports = df.select(
        "ts", (F.col("sensor_id") - 1).alias("vehicle_id"), F.col("units").alias("customer_name"),
        F.lit("BROKEN_DOWN").alias("value"), "seq")

    def results(rows_per_slice):
        return [rows_of(out) for out in (
            ops.running_mean(df, rows_per_slice=rows_per_slice),
            ops.running_mean(df, compat=True, rows_per_slice=rows_per_slice),
            ops.reading_changelog(df, "max_last", rows_per_slice=rows_per_slice),
            ops.reading_changelog(df, "latest", rows_per_slice=rows_per_slice),
            ops.dangerous_valves(observed, min_times=2, rows_per_slice=rows_per_slice),
            ops.potential_causes(reports, alerts, sensors_per_vehicle=1, rows_per_slice=rows_per_slice))]

    for plain, sliced in zip(results(10**6), results(30)):
        assert len(plain) == len(sliced) != 0
        assert all(a == pytest.approx(b) for a, b in zip(map(_comparable, plain), map(_comparable, sliced)))


def _comparable(row):
    return tuple(-1.0 if v is None else v for v in row)


def test_a_hot_null_key_is_listed(tables):
    df = _with_nulls(tables, "sensor_id", 1)
    slices = plan_slices(df, ["sensor_id"], 100)
    assert slices.listed_null
    cut = slices.assign(df).where("sensor_id IS NULL").select("slice").distinct()
    assert cut.count() > 1
