import random

import pytest

from conftest import rows_of
from fleetlens import jobs, operators as ops, schemas, streaming
from fleetlens.__main__ import JOBS, main
from test_patterns import brute_force


@pytest.fixture(scope="module")
def inputs(spark, tables, tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    rng = random.Random(11)
    readings = [(i * 400 + rng.randrange(101, 115), rng.choice([100, 100, 205]), rng.choice([20.0, 20.0, 590.0]))
                for i in range(150)]
    states = [(i * 400 + rng.randrange(97, 100), sensor, rng.choice(["OPEN", "CLOSE", "OBSTRUCTED", "OBSTRUCTED"]))
              for i in range(150) for sensor in (100, 205)]
    frames = {
        "measurements": tables.measurements(*readings),
        "secondary": tables.measurements(*[(ms, sensor, value + 50) for ms, sensor, value in readings]),
        "valves": tables.states(*states),
        "reports": tables.reports(*[(i * 5_000, 1 + i % 2, "BROKEN_DOWN") for i in range(12)]),
        "alerts": tables.alerts(*[(i * 7_000, 100, 600.0) for i in range(8)]),
        "owners": spark.createDataFrame([(1, "Ann", True), (2, "Bob", False)], schemas.OWNER),
        "edits": spark.createDataFrame(
            [(r.ts, "ann", 5, r.seq) for r in tables.measurements(*readings[:20]).collect()], schemas.EDIT),
        "lines": spark.createDataFrame([("to be or not to be",)], schemas.TEXT_LINE),
    }
    for name, df in frames.items():
        df.write.format("text" if name == "lines" else "parquet").save(str(folder / name))
    return folder


def _arguments(inputs, job):
    return [part for name in JOBS[job].inputs for part in (f"--{name}", str(inputs / name))]


@pytest.mark.parametrize("job", sorted(name for name, job in JOBS.items() if job.mode != "stream"))
def test_every_job_runs_on_tables(spark, inputs, tmp_path, job):
    main([job, *_arguments(inputs, job), "--out", str(tmp_path / "out")], spark)
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0


@pytest.mark.parametrize("job", ["heat-alert", "latest-observation", "stolen-vehicles", "sliding-mean-processing-time"])
def test_jobs_run_on_streams(spark, inputs, tmp_path, job):
    main([job, *_arguments(inputs, job), "--stream", "--drain", "--out", str(tmp_path / "out"),
          "--checkpoint", str(tmp_path / "c")], spark)
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_misuse_is_named(spark, inputs):
    with pytest.raises(SystemExit, match="needs --measurements"):
        main(["heat-alert"], spark)
    with pytest.raises(SystemExit, match="tables only"):
        main(["customer-service-sql", *_arguments(inputs, "customer-service-sql"), "--stream"], spark)
    with pytest.raises(SystemExit, match="needs --out"):
        main(["customer-service", *_arguments(inputs, "customer-service"), "--stream"], spark)


def test_pattern_alerts_on_pairs(spark, inputs):
    readings = spark.read.parquet(str(inputs / "measurements"))
    states = spark.read.parquet(str(inputs / "valves"))
    pairs = ops.state_at_reading(readings, states, **jobs.PATTERN_PAIRS)
    rows = [(ms, sensor, value, state, (seq, state_seq)) for ms, sensor, value, state, seq, state_seq in rows_of(
        pairs, "ts", "sensor_id", "value", "state", "seq", "state_seq")]
    expected = sorted((*found[:5], found[5][0]) for found in brute_force(rows))
    assert rows_of(jobs.pattern_alerts(readings, states)) == expected != []


def test_print_job(spark, inputs, capfd):
    main(["print", *_arguments(inputs, "print")], spark)
    assert "CELSIUS" in capfd.readouterr().out
    assert streaming.print_table(spark.range(1)) is None
