"""The two order-dependent analyses as micro-batch jobs over tables.

Keyed state would keep all rows of a key in one task.  These forms run the table version on each micro-batch
instead, where a key that dominates is spread over time slices, and keep what must survive a micro-batch in
tables: everything stays distributed and readable with ``spark.read``.  Order is exact inside a micro-batch.

Under ``path`` every micro-batch ``n`` writes its partition ``batch_id=n`` of the result and of the state
tables, and reads only the state written by ``n - 1`` and before, so a replay after a failure overwrites
its own output and nothing else.  Partitions that no replay can need any more are removed.

``ttl`` bounds what is kept of sensors and vehicles that nothing more is heard of: an entry is forgotten that long
(event time) after its own time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from fleetlens.functions import interval_micros, micros
from fleetlens.operators.causes import KNOWN, last_seen, match_stacked, stack_reports_and_alerts
from fleetlens.operators.joins import state_at_reading
from fleetlens.operators.patterns import (
    CLOSURE, NORMAL, as_pattern_alerts, check_after_match, in_time, longest_per_run, pattern_order, scan_pattern,
)
from fleetlens.plans.slices import ROWS_PER_SLICE
from fleetlens.schemas import SENSORS_PER_VEHICLE, WATERMARK_DELAY
from fleetlens.streaming import files
from fleetlens.streaming.sinks import _each_batch, _write_batch

FULL_EVERY = 50
_READING, _STATE, _TOLD = "reading", "state", "report"


def _written(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """What micro-batches ``first`` to ``last`` wrote; only their own folders are listed."""
    folders = [f"{path}/batch_id={n}" for n in range(first, last + 1)]
    return spark.read.option("basePath", path).parquet(*folders)


def read_causes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/pairs").drop("batch_id")


def read_causes_state(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Last complaint and alert per vehicle (before micro-batch ``before``; by default: now)."""
    table = f"{path}/state"
    if before is None:
        before = 1 + max(int(name.removeprefix("batch_id=")) for name in files.names(spark, table)
                         if name.startswith("batch_id="))
    full = (before - 1) // FULL_EVERY * FULL_EVERY
    newest = F.max_by(F.struct("report", "alert"), "batch_id").alias("_s")
    return _written(spark, table, full, before - 1).groupBy("vehicle_id").agg(newest).select(
        "vehicle_id", "_s.report", "_s.alert")


def _forget(spark: SparkSession, path: str, first: int, last: int) -> None:
    """Remove the partitions of micro-batches ``first`` to ``last``."""
    for n in range(max(first, 0), last + 1):
        files.remove(spark, f"{path}/batch_id={n}")


def match_causes_in_batches(
    reports: DataFrame,
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    within: str = "2 hours",
    sensors_per_vehicle: int = SENSORS_PER_VEHICLE,
    rows_per_slice: int = ROWS_PER_SLICE,
    ttl: str | None = None,
    delay: str = WATERMARK_DELAY,
    drain: bool = False,
) -> StreamingQuery:
    """``potential_causes`` of two streams: exact ``(ts, report before alert, seq)`` order inside each
    micro-batch, arrival order across them.

    The state table gets the vehicles a micro-batch touched, and all of them every ``FULL_EVERY`` batches.
    With ``ttl`` pairs must also lie closer than that, and a complaint or alert leaves the state once an event
    ``ttl`` and ``delay`` past it was seen.
    """
    stacked = stack_reports_and_alerts(reports, alerts, sensors_per_vehicle)

    def act(batch: DataFrame, n: int) -> None:
        batch.persist()
        try:
            newest = None if ttl is None else batch.agg(F.max(micros("ts"))).first()[0]
            now = None if newest is None else newest - interval_micros(delay)
            _match_step(batch, n, path, within, rows_per_slice, ttl, now)
        finally:
            batch.unpersist()

    return _each_batch(stacked, "append", act, checkpoint, drain)


def _match_step(
    batch: DataFrame, n: int, path: str, within: str, rows_per_slice: int, ttl: str | None = None,
    now: int | None = None,
) -> None:
    """Match the stacked rows of one micro-batch and write its pairs and state; later rows are after ``now``."""
    spark = batch.sparkSession
    if ttl is not None:
        within = min(within, ttl, key=interval_micros)
    touched = batch.groupBy("vehicle_id").agg(last_seen("report").alias("report"), last_seen("alert").alias("alert"))
    if n == 0:
        rows, state = batch, touched
    else:
        before = read_causes_state(spark, path, n)
        rows = batch.unionByName(_as_known(before.join(touched, "vehicle_id", "left_semi")))
        kept = before.select("vehicle_id", F.col("report").alias("_r"), F.col("alert").alias("_a"))
        how = "full" if n % FULL_EVERY == 0 else "left"
        state = touched.join(kept, "vehicle_id", how).select(
            "vehicle_id", F.coalesce("report", "_r").alias("report"), F.coalesce("alert", "_a").alias("alert"))
    if ttl is not None and now is not None:
        oldest = now - interval_micros(ttl)
        state = state.withColumns({c: F.when(micros(f"{c}.ts") > oldest, F.col(c)) for c in ("report", "alert")})
    if n % FULL_EVERY == 0:
        state = state.where("report IS NOT NULL OR alert IS NOT NULL")
    _write_batch(match_stacked(rows, within, rows_per_slice=rows_per_slice), f"{path}/pairs", n)
    _write_batch(state, f"{path}/state", n)
    if n % FULL_EVERY == 1 % FULL_EVERY and n > FULL_EVERY:  # the full state before this one is committed
        _forget(spark, f"{path}/state", n - 1 - FULL_EVERY, n - 2)


def _as_known(state: DataFrame) -> DataFrame:
    """State rows in front of everything a micro-batch holds."""
    return state.select(
        "vehicle_id", F.lit("0001-01-01 00:00:00").cast("timestamp").alias("ts"), F.lit(0).cast("long").alias("seq"),
        F.lit("").alias("tie"), F.lit(KNOWN).alias("kind"), "report", "alert")


def read_pattern_alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/alerts").drop("batch_id")


def match_patterns_in_batches(
    observed: DataFrame,
    path: str,
    checkpoint: str,
    delay: str = WATERMARK_DELAY,
    normal: tuple[str, ...] = NORMAL,
    closure: tuple[str, ...] = CLOSURE,
    min_times: int = 5,
    heat_above: float = 500.0,
    after_match: str = "all",
    rows_per_slice: int = ROWS_PER_SLICE,
    ttl: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """``dangerous_valves`` of a stream in event-time order.

    A row is used once an event ``delay`` past it was seen; until then it waits in ``held``.  A row at or
    behind that point on arrival is late and dropped.  ``pending`` holds the starts that wait for the end
    of their run or for heat, ``clock`` the point itself.
    """
    check_after_match(after_match)
    columns = ["sensor_id", "value", "state", *pattern_order(observed)]

    def act(batch: DataFrame, n: int) -> None:
        rows, now = _passed_rows(batch.select(*columns), n, path, delay)
        try:
            ready = rows.where(_upto(now))
            _pattern_step(ready, n, path, normal, closure, min_times, heat_above, after_match, rows_per_slice, ttl, now)
        finally:
            rows.unpersist()

    return _each_batch(observed, "append", act, checkpoint, drain)


def _upto(now: int | None) -> Column:
    return F.lit(False) if now is None else micros("ts") <= now


def _passed_rows(
    rows: DataFrame, n: int, path: str, delay: str, welcome: Column | None = None,
) -> tuple[DataFrame, int | None]:
    """The rows that are not late with those held so far, persisted, and the time up to which they may be used.

    The others are written as held again, and the time to the clock.  Rows that are ``welcome`` stay if late.
    """
    spark, passed = rows.sparkSession, None
    columns = rows.columns
    if n > 0:
        passed = _written(spark, f"{path}/clock", n - 1, n - 1).first()["passed_us"]
        held = _written(spark, f"{path}/held", n - 1, n - 1).select(*columns)
        if passed is not None:
            in_time = micros("ts") > passed
            rows = rows.where(in_time if welcome is None else in_time | welcome)
        rows = rows.unionByName(held)
    rows.persist()
    newest = rows.agg(F.max(micros("ts"))).first()[0]
    seen = [p for p in (passed, None if newest is None else newest - interval_micros(delay)) if p is not None]
    now = max(seen) if seen else None
    _write_batch(rows.where(~_upto(now)), f"{path}/held", n)
    _write_batch(spark.createDataFrame([(now,)], "passed_us long"), f"{path}/clock", n)
    for table in ("held", "clock"):
        _forget(spark, f"{path}/{table}", n - 2, n - 2)
    return rows, now


def _pattern_step(
    ready: DataFrame, n: int, path: str, normal: tuple[str, ...], closure: tuple[str, ...], min_times: int,
    heat_above: float, after_match: str, rows_per_slice: int, ttl: str | None, now: int | None,
) -> DataFrame:
    """Advance the pattern by one micro-batch's rows, write its alerts and waiting starts, give the alerts."""
    spark = ready.sparkSession
    starts, firsts = _starts_and_firsts(
        scan_pattern(ready, normal, closure, heat_above, rows_per_slice=rows_per_slice), n)
    if n > 0:
        pending = _written(spark, f"{path}/pending", n - 1, n - 1).drop("batch_id")
        starts = starts.unionByName(_advance(pending, firsts, n))
    starts = starts.where((F.col("times") >= min_times) | ~F.col("ended")).persist()
    try:
        done = starts.where("ended AND heat IS NOT NULL").where(in_time(ttl))
        waiting = starts.where("NOT ended OR heat IS NULL")
        if ttl is not None:
            if now is not None:  # heat to come is after it
                waiting = waiting.where(micros("ts") + interval_micros(ttl) > now)
            # which start of a run is still known when heat comes decides then
            done = longest_per_run(done) if after_match == "first" else done
        elif after_match == "first":
            # starts whose run ended just now and that share it; older ones were reduced then
            done = longest_per_run(done)
            open_runs, ended = waiting.where(~F.col("ended")), waiting.where("ended")
            waiting = open_runs.unionByName(longest_per_run(ended).withColumn("ended", F.lit(True)))
        _write_batch(as_pattern_alerts(done), f"{path}/alerts", n)
        _write_batch(waiting, f"{path}/pending", n)
        _forget(spark, f"{path}/pending", n - 2, n - 2)
    finally:
        starts.unpersist()
    return _written(spark, f"{path}/alerts", n, n).drop("batch_id")


def match_complaints_with_patterns(
    reports: DataFrame,
    observed: DataFrame,
    path: str,
    checkpoint: str,
    within: str = "2 hours",
    sensors_per_vehicle: int = SENSORS_PER_VEHICLE,
    delay: str = WATERMARK_DELAY,
    normal: tuple[str, ...] = NORMAL,
    closure: tuple[str, ...] = CLOSURE,
    min_times: int = 5,
    heat_above: float = 500.0,
    after_match: str = "all",
    rows_per_slice: int = ROWS_PER_SLICE,
    ttl: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """The customer-service chain as one query: patterns in ``observed`` are matched with ``reports``.

    Both inputs are held until an event ``delay`` past them was seen, so reports and the alerts of the same
    stretch of time meet in event-time order.  Pairs: :func:`read_causes`; alerts: :func:`read_pattern_alerts`;
    state per vehicle: :func:`read_causes_state`.
    """
    check_after_match(after_match)
    columns = ["sensor_id", "value", "state", *pattern_order(observed)]
    both = observed.select(*columns, F.lit(True).alias("is_observed")).unionByName(
        _as_told(reports).withColumn("is_observed", F.lit(False)), allowMissingColumns=True)

    def act(batch: DataFrame, n: int) -> None:
        rows, now = _passed_rows(batch, n, path, delay)
        try:
            ready = rows.where(_upto(now))
            alerts = _pattern_step(ready.where("is_observed").select(*columns), n, path, normal, closure, min_times,
                                   heat_above, after_match, rows_per_slice, ttl, now)
            _complaints_step(ready.where("NOT is_observed"), alerts, n, path, within, sensors_per_vehicle,
                             rows_per_slice, ttl, now)
        finally:
            rows.unpersist()

    return _each_batch(both, "append", act, checkpoint, drain)


def match_complaints_with_readings(
    reports: DataFrame,
    measurements: DataFrame,
    valve_states: DataFrame,
    path: str,
    checkpoint: str,
    pairs: dict[str, str],
    within: str = "2 hours",
    sensors_per_vehicle: int = SENSORS_PER_VEHICLE,
    delay: str = WATERMARK_DELAY,
    normal: tuple[str, ...] = NORMAL,
    closure: tuple[str, ...] = CLOSURE,
    min_times: int = 5,
    heat_above: float = 500.0,
    after_match: str = "all",
    rows_per_slice: int = ROWS_PER_SLICE,
    ttl: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """:func:`match_complaints_with_patterns` of the readings and valve states themselves, joined as in
    :func:`match_patterns_of_readings`."""
    check_after_match(after_match)
    stacked = _readings_and_states(measurements, valve_states).unionByName(
        _as_told(reports).withColumn("what", F.lit(_TOLD)), allowMissingColumns=True)

    def act(batch: DataFrame, n: int) -> None:
        rows, now = _passed_rows(batch, n, path, delay, F.col("what") == _STATE)
        try:
            ready = rows.where(_upto(now))
            observed = _pairs_step(ready, n, path, pairs, now).persist()
            try:
                alerts = _pattern_step(observed, n, path, normal, closure, min_times, heat_above, after_match,
                                       rows_per_slice, ttl, now)
            finally:
                observed.unpersist()
            _complaints_step(ready.where(F.col("what") == _TOLD), alerts, n, path, within, sensors_per_vehicle,
                             rows_per_slice, ttl, now)
        finally:
            rows.unpersist()

    return _each_batch(stacked, "append", act, checkpoint, drain)


def match_patterns_of_readings(
    measurements: DataFrame,
    valve_states: DataFrame,
    path: str,
    checkpoint: str,
    pairs: dict[str, str],
    delay: str = WATERMARK_DELAY,
    normal: tuple[str, ...] = NORMAL,
    closure: tuple[str, ...] = CLOSURE,
    min_times: int = 5,
    heat_above: float = 500.0,
    after_match: str = "all",
    rows_per_slice: int = ROWS_PER_SLICE,
    ttl: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """:func:`match_patterns_in_batches` of readings and valve states that are still to be joined.

    They are joined by ``state_at_reading`` with ``pairs`` for its sizes, as tables, once their time has passed: a
    reading with the states before it, of which ``states`` keeps those that later readings can still reach.  A late
    state still counts for readings that are not late.
    """
    check_after_match(after_match)

    def act(batch: DataFrame, n: int) -> None:
        rows, now = _passed_rows(batch, n, path, delay, F.col("what") == _STATE)
        try:
            observed = _pairs_step(rows.where(_upto(now)), n, path, pairs, now).persist()
            try:
                _pattern_step(observed, n, path, normal, closure, min_times, heat_above, after_match,
                              rows_per_slice, ttl, now)
            finally:
                observed.unpersist()
        finally:
            rows.unpersist()

    return _each_batch(_readings_and_states(measurements, valve_states), "append", act, checkpoint, drain)


def _readings_and_states(measurements: DataFrame, valve_states: DataFrame) -> DataFrame:
    return measurements.select("ts", "sensor_id", "units", "value", "seq", F.lit(_READING).alias("what")).unionByName(
        valve_states.select("ts", "sensor_id", "state", "seq", F.lit(_STATE).alias("what")), allowMissingColumns=True)


def _pairs_step(ready: DataFrame, n: int, path: str, pairs: dict[str, str], now: int | None) -> DataFrame:
    """The readings of one micro-batch with the states before them; writes the states that later readings can reach."""
    spark, told = ready.sparkSession, ["ts", "sensor_id", "state", "seq"]
    pairs = {"size": "200 milliseconds", "within": "20 milliseconds", **pairs}  # as state_at_reading has them
    readings = ready.where(F.col("what") == _READING).select("ts", "sensor_id", "units", "value", "seq")
    states = ready.where(F.col("what") == _STATE).select(*told)
    if n > 0:
        states = states.unionByName(_written(spark, f"{path}/states", n - 1, n - 1).select(*told))
    oldest = F.lit(None if now is None else now - interval_micros(pairs["within"])).cast("long")
    _write_batch(states.where(micros("ts") > oldest), f"{path}/states", n)
    _forget(spark, f"{path}/states", n - 2, n - 2)
    return state_at_reading(readings, states, **pairs).select("ts", "sensor_id", "value", "state", "seq", "state_seq")


def _as_told(reports: DataFrame) -> DataFrame:
    return reports.select("ts", "vehicle_id", "customer_name", "seq", F.col("value").alias("report_value"))


def _complaints_step(
    told: DataFrame, alerts: DataFrame, n: int, path: str, within: str, sensors_per_vehicle: int, rows_per_slice: int,
    ttl: str | None, now: int | None,
) -> None:
    """Match the reports and alerts of one micro-batch."""
    complaints = told.select("ts", "vehicle_id", "customer_name", "seq", F.col("report_value").alias("value"))
    stacked = stack_reports_and_alerts(complaints, alerts, sensors_per_vehicle).persist()
    _match_step(stacked, n, path, within, rows_per_slice, ttl, now)
    stacked.unpersist()


def _run(n: int, end: str) -> Column:
    return F.concat(F.lit(f"{n}:"), F.col(end).cast("string"))


def _starts_and_firsts(scanned: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Starts among the scanned rows, and per sensor what an older start meets there first.

    A start: ``times`` so far, whether its run ``ended``, and the ``heat`` after it if seen.
    """
    ended = F.col("end").isNotNull()
    starts = scanned.where("normal").select(
        "sensor_id", "ts", "seq",
        F.when(ended, _run(n, "end.pos")).alias("run"),
        (F.col("pos") - F.coalesce("end.pos", F.lit(0)) - 1).alias("times"),
        F.col("end.heat").alias("heat"), ended.alias("ended"),
    )
    own_end = F.when(~F.col("closed"), F.struct("pos", "heat"))
    first = F.struct("pos", "heat", F.coalesce(own_end, F.col("end")).alias("end"))
    return starts, scanned.groupBy("sensor_id").agg(F.max_by(first, "pos").alias("first"))


def _advance(pending: DataFrame, firsts: DataFrame, n: int) -> DataFrame:
    """Pending starts after the new rows of their sensor."""
    met, ends_now = F.col("first"), F.col("first.end").isNotNull() & ~F.col("ended")
    grown = F.when(F.col("ended") | met.isNull(), F.lit(0)).otherwise(
        F.col("first.pos") - F.coalesce("first.end.pos", F.lit(0)))
    return pending.join(firsts, "sensor_id", "left").select(
        "sensor_id", "ts", "seq",
        F.when(ends_now, _run(n, "first.end.pos")).otherwise(F.col("run")).alias("run"),
        (F.col("times") + grown).alias("times"),
        F.when(F.col("ended"), F.col("first.heat")).when(ends_now, F.col("first.end.heat")).alias("heat"),
        (F.col("ended") | ends_now).alias("ended"),
    )
