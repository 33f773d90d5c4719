"""Which records came too late, decided per record in order of arrival.

A streaming engine drops a record once the watermark (the latest event time seen, less a delay) has passed the
end of every window it belongs to.  Spark's own filter lags one micro-batch behind and tells no more than a count.
Here the running maximum of event time over the records that arrived before decides about each record, so the
answer does not depend on how arrivals are cut into micro-batches, and late records are rows like any other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.functions import floor_div, interval_micros, micros
from fleetlens.plans import ordered_scan
from fleetlens.plans.slices import ROWS_PER_SLICE
from fleetlens.schemas import WATERMARK_DELAY

_BEFORE = (Window.unboundedPreceding, -1)


def _last_end(size: str | None, slide: str | None) -> Column:
    """End of the last window that holds a record, in microseconds; its own time without windows."""
    if size is None:
        return micros("ts")
    step = interval_micros(slide or size)
    return floor_div(micros("ts"), step) * step + interval_micros(size)


def mark_late(
    records: DataFrame, delay: str = WATERMARK_DELAY, size: str | None = None, slide: str | None = None,
    seen: dt.datetime | None = None, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``records`` (ts, seq) with ``late``: true where the watermark had passed on arrival.

    With ``size`` (and ``slide``) a record is late once the last of its windows is closed, that is its end is not
    after the watermark; without, once the watermark is not before its own time.  ``seen`` is the latest event
    time that arrived before all of them.  The first record is never late.
    """
    scanned = ordered_scan(
        records, [], ["seq"],
        local=lambda w: [{"_run": F.max("ts").over(w.rowsBetween(*_BEFORE))}],
        totals={"_top": F.max("ts")},
        inherit=lambda w: [{"_prior": F.max("_top").over(w.rowsBetween(*_BEFORE))}],
        inherited="_prior timestamp", rows_per_slice=rows_per_slice,
    )
    latest = F.greatest("_run", "_prior", F.lit(seen).cast("timestamp"))
    late = F.coalesce(_last_end(size, slide) <= micros(latest) - interval_micros(delay), F.lit(False))
    return scanned.select(*records.columns, late.alias("late"))
