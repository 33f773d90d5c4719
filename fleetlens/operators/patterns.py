"""Ordered failure pattern: a normal row, then a run of closures, then heat.

Per sensor, rows ordered by ``(ts, seq)``, pairs of one reading then by ``state_seq``:

* a *run* is a maximal block of consecutive rows whose state is in ``closure``;
* a *start* is a row whose state is in ``normal`` and that is followed, up to the end of the run, by
  ``n >= min_times`` closure rows (CLOSE is in both sets, so a row inside a run can be a start);
* *heat* is the first row after the end of that run with a value above ``heat_above``.

Scanned from the last row to the first, all of it is "the nearest later row that ...": the nearest later
row outside ``closure`` ends the run, its distance gives ``n``, and the nearest hot row at or after it is
the heat.  So the scan needs nothing but running ``last(..., ignore nulls)`` and row numbers, which
:func:`fleetlens.plans.ordered_scan` can hand across time slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.functions import interval_micros, micros
from fleetlens.plans import Slices, ordered_scan
from fleetlens.plans.slices import ROWS_PER_SLICE
from fleetlens.schemas import CLOSE, LEVEL_PATTERN, OBSERVED_STATE, OBSTRUCTED, OPEN, UNITS_NOT_OPENING, expect

_UPTO = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)
NORMAL, CLOSURE = (OPEN, CLOSE), (CLOSE, OBSTRUCTED)


def pattern_order(observed: DataFrame) -> list[str]:
    """Ordering columns: one reading joined with several states is told apart by ``state_seq``."""
    expect(observed, OBSERVED_STATE)
    return ["ts", "seq", *(["state_seq"] if "state_seq" in observed.columns else [])]


def scan_pattern(
    observed: DataFrame,
    normal: tuple[str, ...] = NORMAL,
    closure: tuple[str, ...] = CLOSURE,
    heat_above: float = 500.0,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """For every row: ``pos`` (1 is the last row of its sensor), ``heat`` (nearest hot row from here on),
    ``end`` (nearest later row outside ``closure``: its ``pos`` and ``heat``), ``normal``, ``closed``."""
    order = pattern_order(observed)
    rows = observed.select(
        "sensor_id", *order,
        # one column for both state sets: the two readers of the sliced rows then share one shuffle
        (F.col("state").isin(*normal).cast("int") + 2 * F.col("state").isin(*closure).cast("int")).alias("_sets"),
        F.when((F.col("value") > heat_above) & ~F.isnan("value"),
               F.struct(F.col("ts").alias("ts"), F.col("value").alias("value"))).alias("_hot"),
    )
    ends_run = F.col("_sets") < 2
    here = F.struct(F.col("_pos").alias("pos"), F.col("_heat").alias("heat"))
    heat = "struct<ts:timestamp,value:double>"
    scanned = ordered_scan(
        rows, ["sensor_id"], order, backwards=True,
        local=lambda w: [
            {"_pos": F.row_number().over(w).cast("long"),
             "_heat": F.last("_hot", ignorenulls=True).over(w.rowsBetween(*_UPTO))},
            {"_end": F.last(F.when(ends_run, here), ignorenulls=True).over(w.rowsBetween(*_BEFORE))},
        ],
        totals={
            "_rows": F.count(F.lit(1)),
            "_first_heat": F.max_by("_heat", "_pos"),
            "_first_end": F.max(F.when(ends_run, here)),
        },
        inherit=lambda w: [
            {"_later": F.sum("_rows").over(w.rowsBetween(*_BEFORE)),
             "_later_heat": F.last("_first_heat", ignorenulls=True).over(w.rowsBetween(*_BEFORE))},
            {"_slice_end": F.when(F.col("_first_end").isNotNull(), F.struct(
                (F.col("_first_end.pos") + F.coalesce("_later", F.lit(0))).alias("pos"),
                F.coalesce("_first_end.heat", "_later_heat").alias("heat")))},
            {"_later_end": F.last("_slice_end", ignorenulls=True).over(w.rowsBetween(*_BEFORE))},
        ],
        inherited=f"_later long, _later_heat {heat}, _later_end struct<pos:long,heat:{heat}>",
        slices=slices, rows_per_slice=rows_per_slice,
    )
    later = F.coalesce("_later", F.lit(0))
    in_slice = F.when(F.col("_end").isNotNull(), F.struct(
        (F.col("_end.pos") + later).alias("pos"), F.coalesce("_end.heat", "_later_heat").alias("heat")))
    return scanned.select(
        "sensor_id", "ts", "seq", (F.col("_pos") + later).alias("pos"),
        F.coalesce("_heat", "_later_heat").alias("heat"),
        F.coalesce(in_slice, F.col("_later_end")).alias("end"),
        (F.col("_sets") % 2 == 1).alias("normal"), (~ends_run).alias("closed"),
    )


def scan_relaxed(
    observed: DataFrame, normal: tuple[str, ...] = NORMAL, closure: tuple[str, ...] = CLOSURE, heat_above: float = 500.0,
    slices: Slices | None = None, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """For every row: ``closures`` from it to the end, whether the very next row is one (``led``), and the ``heat``
    after it (time, value, closures from there on): the nearest later hot row outside ``closure``."""
    order = pattern_order(observed)
    rows = observed.select(
        "sensor_id", *order, F.col("state").isin(*normal).alias("normal"),
        F.col("state").isin(*closure).cast("long").alias("_closed"),
        ((F.col("value") > heat_above) & ~F.isnan("value") & ~F.col("state").isin(*closure)).alias("_hot"), "value",
    )
    here = F.when(F.col("_hot"), F.struct("ts", "value", F.col("_count").alias("closures")))
    heat = "struct<ts:timestamp,value:double,closures:long>"
    scanned = ordered_scan(
        rows, ["sensor_id"], order, backwards=True,
        local=lambda w: [
            {"_count": F.sum("_closed").over(w.rowsBetween(*_UPTO)), "_next": F.lag("_closed").over(w)},
            {"_heat": F.last(here, ignorenulls=True).over(w.rowsBetween(*_BEFORE))},
        ],
        totals={
            "_closures": F.sum("_closed"),
            "_first_closed": F.min_by("_closed", F.struct(*order)),
            "_first_heat": F.min_by(here, F.when(F.col("_hot"), F.struct(*order))),
        },
        inherit=lambda w: [
            {"_later": F.sum("_closures").over(w.rowsBetween(*_BEFORE)),
             "_later_next": F.last("_first_closed").over(w.rowsBetween(*_BEFORE))},
            {"_slice_heat": _moved("_first_heat")},
            {"_later_heat": F.last("_slice_heat", ignorenulls=True).over(w.rowsBetween(*_BEFORE))},
        ],
        inherited=f"_later long, _later_next long, _later_heat {heat}",
        slices=slices, rows_per_slice=rows_per_slice,
    )
    return scanned.select(
        "sensor_id", "ts", "seq", "normal", (F.col("_closed") == 1).alias("closed"),
        (F.col("_count") + F.coalesce("_later", F.lit(0))).alias("closures"),
        (F.coalesce("_next", "_later_next") == 1).alias("led"),
        F.coalesce(_moved("_heat"), F.col("_later_heat")).alias("heat"),
    )


def _moved(heat: str) -> Column:
    """A heat with the closures of later slices counted in."""
    return F.when(F.col(heat).isNotNull(), F.struct(
        F.col(f"{heat}.ts").alias("ts"), F.col(f"{heat}.value").alias("value"),
        (F.col(f"{heat}.closures") + F.coalesce("_later", F.lit(0))).alias("closures")))


def relaxed_matches(scanned: DataFrame, min_times: int) -> DataFrame:
    """Starts of :func:`scan_relaxed` with the ``min_times``-th closure after them, and the heat after that.

    Counted from the end, closures of a sensor have numbers of their own, so the one a start needs is found by an
    equality join that no sensor can make uneven.
    """
    key = F.struct("sensor_id").alias("_key")  # a struct is never NULL
    after = F.col("closures") - F.col("closed").cast("long")
    starts = scanned.where("normal AND led").select(
        key, "sensor_id", "ts", "seq", after.alias("after"), (after - min_times + 1).alias("_needed")).where("_needed > 0")
    ends = scanned.where("closed AND heat IS NOT NULL").select(key, F.col("closures").alias("_needed"), "heat")
    return starts.join(ends, ["_key", "_needed"]).select(
        "sensor_id", "ts", "seq", (F.col("after") - F.col("heat.closures")).alias("times"), "heat")


def longest_per_run(found: DataFrame) -> DataFrame:
    """Of the starts that share a run only the earliest, which has the longest match."""
    return (
        found.groupBy("sensor_id", "run", "heat").agg(F.max(F.struct("times", "seq", "ts")).alias("_best"))
        .select("sensor_id", "run", "heat", "_best.times", "_best.seq", "_best.ts")
    )


def as_pattern_alerts(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("heat.ts").alias("ts"), "sensor_id",
        F.concat(F.lit(UNITS_NOT_OPENING), F.col("times").cast("string")).alias("units"),
        F.col("heat.value").alias("value"), F.lit(LEVEL_PATTERN).alias("level"), "seq",
    )


def dangerous_valves(
    observed: DataFrame,
    normal: tuple[str, ...] = NORMAL,
    closure: tuple[str, ...] = CLOSURE,
    min_times: int = 5,
    heat_above: float = 500.0,
    after_match: str = "all",
    ttl: str | None = None,
    compat: bool = False,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Level 5 alerts for the pattern above; value and time are those of the heat row.

    ``observed`` holds ``ts, sensor_id, value, state, seq``, e.g. the output of ``state_at_reading``.
    ``after_match="all"`` gives one alert per start, ``"first"`` the longest one per run.  ``seq`` of an
    alert is that of its start row.  With ``ttl`` a start is forgotten that long after its own time: only heat
    before that counts.

    ``compat=True`` takes the repetition as loosely as the original exercise literally writes it: the row right after
    the start is a closure, further ones may have other rows between them, as many as there are before the heat, which
    is the first hot row outside ``closure`` behind the ``min_times``-th of them.  Every start gives its alert.
    """
    check_after_match(after_match)
    if compat:
        if after_match != "all":
            raise ValueError("compat gives all matches")
        loose = relaxed_matches(scan_relaxed(observed, normal, closure, heat_above, slices, rows_per_slice), min_times)
        return as_pattern_alerts(loose.where(in_time(ttl)))
    scanned = scan_pattern(observed, normal, closure, heat_above, slices, rows_per_slice)
    found = scanned.where("normal").select(
        "sensor_id", "ts", "seq", F.col("end.pos").alias("run"), (F.col("pos") - F.col("end.pos") - 1).alias("times"),
        F.col("end.heat").alias("heat"),
    ).where((F.col("times") >= min_times) & F.col("heat").isNotNull() & in_time(ttl))
    return as_pattern_alerts(longest_per_run(found) if after_match == "first" else found)


def in_time(ttl: str | None) -> Column:
    """Whether the heat of a start came before the start was forgotten."""
    return F.lit(True) if ttl is None else micros("heat.ts") < micros("ts") + interval_micros(ttl)


def check_after_match(after_match: str) -> None:
    if after_match not in ("all", "first"):
        raise ValueError(f"after_match is 'all' or 'first', not {after_match!r}")
