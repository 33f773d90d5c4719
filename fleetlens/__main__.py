"""Run one job from files: ``python -m fleetlens heat-alert --measurements in --out out [--stream]``.

Use with ``spark-submit`` on a cluster.  Without ``--out`` the rows are printed.  A stream runs every five
seconds until stopped; with ``--drain`` it works off what is there and ends.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from fleetlens import jobs, operators as ops, sources, streaming
from fleetlens.plans import build_session
from fleetlens.plans.session import shared_dir

LOADERS = {
    "measurements": sources.load_measurements,
    "secondary": sources.load_measurements,
    "valves": sources.load_valve_states,
    "reports": sources.load_customer_reports,
    "alerts": sources.load_alerts,
    "owners": sources.load_owners,
    "edits": sources.load_edits,
    "lines": sources.load_text_lines,
}
TABLES_ONLY_INPUTS = ("owners",)


@dataclass(frozen=True)
class Job:
    inputs: tuple[str, ...]
    run: Callable[..., DataFrame]
    mode: str = "append"  # output mode as a stream; "table" where it is for tables only, "stream" the reverse
    #: Called with the inputs, the output path, the checkpoint and ``drain`` where a stream writes its own tables.
    stream: Callable[..., StreamingQuery] | None = None


def _timed(fn: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: fn(sources.with_event_time(df))


def _owners_of(measurements: DataFrame, valves: DataFrame, owners: DataFrame) -> DataFrame:
    return ops.with_owner(ops.vehicle_activity(measurements, valves), owners)


def _complaints_sql(reports: DataFrame, alerts: DataFrame) -> DataFrame:
    ops.publish_reports(reports)
    ops.publish_alerts(alerts)
    return ops.potential_causes_sql(reports.sparkSession)


JOBS: dict[str, Job] = {
    "print": Job(("measurements",), lambda m: m),
    "to-fahrenheit": Job(("measurements",), ops.to_fahrenheit),
    "fahrenheit-and-celsius": Job(("measurements",), ops.fahrenheit_and_celsius),
    "heat-alert": Job(("measurements",), ops.heat_alerts),
    "latest-observation": Job(("measurements",), ops.latest_observation, "update"),
    "max-temperature": Job(("measurements",), lambda m: ops.max_reading(m, "last"), "update"),
    "max-temperature-first": Job(("measurements",), lambda m: ops.max_reading(m, "first"), "update"),
    "mean-temperature": Job(("measurements",), ops.running_mean, "update"),
    "sliding-mean-processing-time": Job(
        ("measurements",), lambda m: ops.sliding_mean(sources.with_processing_time(m), time="pt"), "stream"),
    "sliding-mean": Job(("measurements",), _timed(ops.sliding_mean)),
    "secondary-sensor": Job(("measurements", "secondary"), jobs.redundant_sensor_alerts),
    "secondary-sensor-compat": Job(
        ("measurements", "secondary"), lambda p, s: jobs.redundant_sensor_alerts(p, s, compat=True)),
    "mean-performance": Job(("measurements", "valves"), jobs.mean_performance),
    "state-temperature": Job(("measurements", "valves"), jobs.state_temperature_alerts),
    "vehicle-activity": Job(("measurements", "valves"), ops.vehicle_activity),
    "vehicle-owner": Job(("measurements", "valves", "owners"), _owners_of),
    "stolen-vehicles": Job(("measurements", "valves", "owners"), jobs.stolen_vehicle_activity),
    "dangerous-valves": Job(("measurements", "valves"), jobs.pattern_alerts, stream=jobs.pattern_alerts_stream),
    "customer-service": Job(
        ("reports", "measurements", "valves"), jobs.customer_service, stream=jobs.customer_service_stream),
    "customer-service-sql": Job(("reports", "measurements", "valves"), jobs.customer_service_sql, "table"),
    "customer-service-lookup": Job(("reports", "measurements", "valves"), jobs.customer_service_lookup, "table"),
    "match-complaints": Job(("reports", "alerts"), ops.potential_causes, stream=jobs.complaints_stream),
    "match-complaints-sql": Job(("reports", "alerts"), _complaints_sql),
    "latest-per-vehicle": Job(("reports", "alerts"), ops.latest_per_vehicle, "update"),
    "edit-bytes": Job(("edits",), _timed(ops.edit_bytes_per_user)),
    "word-count": Job(("lines",), ops.word_count, "update"),
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fleetlens", description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    for name in LOADERS:
        parser.add_argument(f"--{name}", help=f"path of the {name}")
    parser.add_argument("--format", help="file format of the inputs (default: parquet, text for lines)")
    parser.add_argument("--out", help="parquet table to write; printed if not given")
    parser.add_argument("--stream", action="store_true", help="read the inputs as streams")
    parser.add_argument("--drain", action="store_true", help="end when the input is worked off")
    parser.add_argument("--checkpoint", help="checkpoint folder of a stream (default: in the shared folder)")
    return parser


def _load(spark: SparkSession, name: str, args: argparse.Namespace) -> DataFrame:
    path = getattr(args, name)
    if path is None:
        raise SystemExit(f"{args.job} needs --{name}")
    options = {"stream": args.stream and name not in TABLES_ONLY_INPUTS}
    if args.format and name != "lines":
        options["fmt"] = args.format
    return LOADERS[name](spark, path, **options)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    job = JOBS[args.job]
    if args.stream and job.mode == "table" or not args.stream and job.mode == "stream":
        raise SystemExit(f"{args.job} is for {job.mode}s only")
    spark = spark or build_session(f"fleetlens {args.job}")
    inputs = [_load(spark, name, args) for name in job.inputs]
    checkpoint = args.checkpoint or f"{shared_dir(spark)}/fleetlens/{args.job}"
    if args.stream and job.stream:
        if not args.out:
            raise SystemExit(f"{args.job} as a stream needs --out, the folder of its tables")
        job.stream(*inputs, args.out, checkpoint, args.drain).awaitTermination()
        return
    result = job.run(*inputs)
    if not args.stream:
        if args.out:
            result.write.mode("overwrite").parquet(args.out)
        else:
            streaming.print_table(result)
        return
    if job.mode == "append":
        query = (streaming.write_append(result, args.out, checkpoint, args.drain) if args.out
                 else streaming.print_stream(result, checkpoint, drain=args.drain))
    else:
        query = (streaming.write_updates(result, args.out, checkpoint, args.drain) if args.out
                 else streaming.print_stream(result, checkpoint, "update", args.drain))
    query.awaitTermination()


if __name__ == "__main__":
    main()
