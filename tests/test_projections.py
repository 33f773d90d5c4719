import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from fleetlens import operators as ops
from fleetlens.functions import floor_div, interval_micros, tokens
from fleetlens.sources import from_epoch_millis


def test_to_fahrenheit_keeps_other_fields(tables):
    out = ops.to_fahrenheit(tables.measurements((5, 1, 100.0), (6, 2, 0.0)))
    assert rows_of(out) == [(5, 1, "FAHRENHEIT", 212.0, 0), (6, 2, "FAHRENHEIT", 32.0, 1)]


def test_fahrenheit_and_celsius_gives_both(tables):
    out = ops.fahrenheit_and_celsius(tables.measurements((5, 1, 100.0)))
    assert [r.units for r in out.collect()] == ["CELSIUS", "FAHRENHEIT"]
    assert rows_of(out, "value") == [(100.0,), (212.0,)]


def test_heat_alert_is_strict(tables):
    out = ops.heat_alerts(tables.measurements((1, 1, 550.0), (2, 1, 550.0001), (3, 2, float("nan"))))
    assert rows_of(out) == [(2, 1, "CELSIUS", 550.0001, 2, 1)]


def test_tag_readings_is_a_bag(tables):
    same = tables.measurements((1, 1, 2.0), (1, 1, 2.0))
    assert rows_of(ops.tag_readings(same, same), "type") == [("PRIMARY",)] * 2 + [("SECONDARY",)] * 2


def test_vehicle_activity_divides_whole(tables):
    out = ops.vehicle_activity(tables.measurements((1, 199, 1.0)), tables.states((2, 11080, "OPEN")))
    assert rows_of(out) == [(1, 1, 1), (110, 1, 2)]


def test_wrong_input_is_named(tables):
    readings = tables.measurements((1, 1, 1.0))
    with pytest.raises(ValueError, match="state missing"):
        ops.stack_observations(readings, readings)
    with pytest.raises(ValueError, match="value is string"):
        ops.to_fahrenheit(tables.measurements((1, 1, 1.0)).withColumn("value", F.lit("x")))


def test_word_count_on_the_sample_lines(spark):
    lines = [
        ("To be, or not to be,--that is the question:--",),
        ("Whether 'tis nobler in the mind to suffer",),
        ("The slings and arrows of outrageous fortune",),
        ("Or to take arms against a sea of troubles,",),
    ]
    counts = dict(rows_of(ops.word_count(spark.createDataFrame(lines, "value string"))))
    assert counts["to"] == 4 and counts["the"] == 3 and counts["be"] == 2 and counts["or"] == 2
    assert "" not in counts and sum(counts.values()) == 34


@pytest.mark.parametrize("rows_per_slice", [100, 3])
def test_word_count_changelog(spark, rows_per_slice):
    lines = spark.createDataFrame([(1, "a b a"), (2, "a, b--"), (3, "a a")], "seq long, value string")
    out = ops.word_count_changelog(lines, rows_per_slice=rows_per_slice)
    assert rows_of(out) == [(1, 0, "a", 1), (1, 1, "b", 1), (1, 2, "a", 2), (2, 0, "a", 3), (2, 1, "b", 2),
                            (3, 0, "a", 4), (3, 1, "a", 5)]


def test_tokens_drop_empty_strings(spark):
    row = spark.createDataFrame([("--x,, Y--",)], "t string").select(tokens("t").alias("w")).first()
    assert row.w == ["x", "y"]


def test_intervals_and_floor_division(spark):
    assert interval_micros("200 milliseconds") == 200_000 and interval_micros("1 hour") == 3_600_000_000
    with pytest.raises(ValueError):
        interval_micros("1 month")
    values = spark.createDataFrame([(-1,), (0,), (199,), (200,)], "x long")
    assert rows_of(values.select(floor_div(F.col("x"), 200).alias("q"))) == [(-1,), (0,), (0,), (1,)]


def test_epoch_millis(spark):
    out = from_epoch_millis(spark.createDataFrame([(1500,)], "timestamp long"))
    assert out.columns == ["ts"] and rows_of(out) == [(1500,)]
