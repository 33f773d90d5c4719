import re

import pytest
from pyspark.sql import functions as F

from fleetlens import operators as ops, schemas
from fleetlens.catalog import QUERIES
from fleetlens.sources import load_measurements, load_owners

DATA = "/root/testdata/sf0.001"
# The sizes at which AQE splits a partition, brought down to the size of test tables.
SPLIT_EARLY = {
    "autoBroadcastJoinThreshold": "-1",
    "adaptive__skewJoin__skewedPartitionThresholdInBytes": "1KB",
    "adaptive__skewJoin__skewedPartitionFactor": "1.1",
    "adaptive__advisoryPartitionSizeInBytes": "1KB",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    """The adaptive plan after running ``df``."""
    df.collect()
    return plan_of(df).split("Initial Plan")[0]


@pytest.fixture
def conf(spark):
    before = {}

    def put(**settings):
        for key, value in settings.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture(scope="module")
def readings(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("readings") / "t")
    spark.range(2_000).select(
        F.timestamp_millis(F.col("id") * 7).alias("ts"), (F.col("id") % 50).alias("sensor_id"),
        F.lit("CELSIUS").alias("units"), (F.col("id") % 600).cast("double").alias("value"), F.col("id").alias("seq"),
    ).write.parquet(path)
    return load_measurements(spark, path)


@pytest.mark.parametrize("make", [
    lambda df: ops.latest_observation(df, sensor_id=7),
    lambda df: ops.max_reading(df, sensor_id=7),
    lambda df: ops.sliding_mean(df, sensor_id=7),
    lambda df: ops.running_mean(df, sensor_id=7),
])
def test_a_filter_on_the_key_reaches_the_scan(readings, make):
    assert "EqualTo(sensor_id,7)" in plan_of(make(readings))


def test_a_threshold_reaches_the_scan(readings):
    assert "GreaterThan(value,550.0)" in plan_of(ops.heat_alerts(readings))


def test_only_needed_columns_are_read(readings):
    schema = re.search(r"ReadSchema: (\S+)", plan_of(ops.sliding_mean(readings))).group(1)
    assert schema == "struct<ts:timestamp,sensor_id:bigint,value:double>"


def test_windows_are_reduced_before_the_shuffle(readings):
    plan = plan_of(ops.sliding_mean(readings))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
    assert plan.index("partial_avg") > plan.index("Exchange")


def _activity_and_owners(spark, readings, tmp_path):
    spark.range(20).select(
        F.col("id").alias("vehicle_id"), F.lit("x").alias("owner_name"), (F.col("id") == 1).alias("reported_stolen"),
    ).write.parquet(str(tmp_path / "owners"))
    activity = ops.vehicle_activity(readings, readings.select("ts", "sensor_id", F.lit("OPEN").alias("state"), "seq"), 10)
    return activity, load_owners(spark, str(tmp_path / "owners"))


def test_owner_join_strategy_follows_measured_size(spark, readings, tmp_path, conf):
    activity, owners = _activity_and_owners(spark, readings, tmp_path)
    assert "BroadcastHashJoin" in plan_of(ops.with_owner(activity, owners))
    conf(autoBroadcastJoinThreshold="-1")
    assert "SortMergeJoin" in plan_of(ops.with_owner(activity, owners))


def test_stolen_filter_is_applied_to_the_owners_first(spark, readings, tmp_path):
    plan = plan_of(ops.stolen_vehicles(ops.with_owner(*_activity_and_owners(spark, readings, tmp_path))))
    assert "LeftOuter" not in plan and "EqualTo(reported_stolen,true)" in plan


def test_a_hot_vehicle_is_split_in_the_owner_join(spark, readings, tmp_path, conf):
    activity, owners = _activity_and_owners(spark, readings, tmp_path)
    hot = activity.withColumn("vehicle_id", F.when(F.rand(1) < 0.9, F.lit(3)).otherwise(F.col("vehicle_id")).cast("long"))
    conf(**SPLIT_EARLY)
    joined = ops.with_owner(hot.repartition(6), owners)
    assert "skew=true" in final_plan_of(joined)
    assert joined.count() == 4_000


def test_a_hot_pair_group_is_split_and_stays_whole(spark, conf):
    """All readings and states of one sensor within one step of one window."""
    n = 400
    base = spark.range(n).repartition(4)
    near = base.select(F.timestamp_micros(F.col("id") * 10 + 5).alias("ts"), F.lit(1).cast("long").alias("sensor_id"),
                       F.lit("CELSIUS").alias("units"), F.lit(1.0).alias("value"), F.col("id").alias("seq"))
    states = base.select(F.timestamp_micros(F.col("id") * 10).alias("ts"), F.lit(1).cast("long").alias("sensor_id"),
                         F.lit("OPEN").alias("state"), F.col("id").alias("seq"))
    conf(**SPLIT_EARLY)
    pairs = ops.state_at_reading(near, states)
    assert "skew=true" in final_plan_of(pairs)
    assert pairs.count() == n * (n + 1) // 2


def test_sliced_pattern_scan_shuffles_its_rows_once(tables):
    observed = tables.observed(*[(i, i % 3, 20.0, "CLOSE") for i in range(200)])
    assert "ReusedExchange" in final_plan_of(ops.dangerous_valves(observed, rows_per_slice=20))


def test_sliced_running_mean_reduces_totals_before_their_shuffle(readings):
    plan = plan_of(ops.running_mean(readings, rows_per_slice=10))
    assert "partial_sum" in plan and plan.count("FileScan") == 2


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_pairwise_joins_in_table_queries(spark, name):
    plan = plan_of(QUERIES[name](spark, DATA))
    assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_record_types_are_not_nullable():
    for schema in (schemas.MEASUREMENT, schemas.VALVE_STATE, schemas.CUSTOMER_REPORT, schemas.SENSOR_ALERT):
        assert not any(f.nullable for f in schema.fields)
