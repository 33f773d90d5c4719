"""Ordered scans that survive a key holding a third of all rows.

A running aggregate or "last seen" rule needs the rows of a key in order, and a plain
``Window.partitionBy(key)`` gives all rows of a key to one task.  That is right for keys of ordinary size.
Where some keys exceed ``rows_per_slice`` rows, *their timeline* is cut into slices of about equal row
counts, so that no (key, slice) group is larger than a slice:

1. inside each (key, slice): the ordinary window functions; keys of ordinary size have one slice;
2. one row of totals per (key, slice), pre-aggregated before its shuffle where the totals do not depend
   on step 1;
3. over those totals only (at most ``max_slices`` rows per key): what each slice inherits from the ones
   before it, or after it;
4. a join by (key, slice) hands the inherited values back to the rows.  Rows are already partitioned by
   (key, slice) from step 1, so they are not shuffled again.

Slice limits are constants found once from quantiles of the first ordering column; an instant so busy
that it would fill slices on its own is cut further by the second one.  They only steer balance: any
limits give the same result.  A table without large keys takes the plain window and pays for no more
than the count of rows per key.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from fleetlens.functions import micros

ROWS_PER_SLICE = 4_000_000
MAX_SLICES = 262_144  # 10**12 rows at the size above
MAX_LISTED_KEYS = 1_000  # with more large keys than this, all keys are sliced
_SUB = 1 << 16  # room for the sub-slices of one instant


@dataclass(frozen=True)
class Slices:
    """Constant limits in the first ordering column (times in microseconds), and limits in the second
    one inside busy instants; they apply to the ``listed`` values of column ``key`` (and to NULL with
    ``listed_null``), or to all rows."""

    times: tuple[int, ...] = ()
    busy: dict[int, tuple[int, ...]] = field(default_factory=dict)
    key: str | None = None
    listed: tuple[Any, ...] = ()
    listed_null: bool = False

    @property
    def single(self) -> bool:
        return not self.times and not self.busy

    @property
    def limits(self) -> list[int]:
        """All limits in the first ordering column; a busy instant gets a slice range of its own."""
        return sorted({*self.times, *self.busy, *(instant + 1 for instant in self.busy)})

    def assign(self, df: DataFrame, order: Sequence[str] = ("ts", "seq")) -> DataFrame:
        """Add ``slice``, which grows with the ordering columns."""
        if self.single:
            return df.withColumn("slice", F.lit(0).cast("long"))
        cutter = Bucketizer(
            splits=[float("-inf"), *map(float, self.limits), float("inf")],
            inputCol="_us", outputCol="_cut", handleInvalid="error",
        )
        place = _place(df, order[0])
        cut = cutter.transform(df.withColumn("_us", place.cast("double")))
        part = F.col("_cut").cast("long") * F.lit(_SUB)
        if self.busy:
            limits = F.map_from_arrays(
                F.array(*[F.lit(t).cast("long") for t in self.busy]),
                F.array(*[F.array(*[F.lit(s).cast("long") for s in self.busy[t]]) for t in self.busy]),
            )
            below = F.size(F.filter(F.element_at(limits, place), lambda limit: limit <= F.col(order[1])))
            part = part + F.when(place.isin(*self.busy), below).otherwise(0)
        if self.key:
            part = F.when(_listed(self.key, self.listed, self.listed_null), part)
        # never NULL, so that a join on it adds no filter and both its sides can share one shuffle
        return cut.withColumn("slice", F.coalesce(part, F.lit(0))).drop("_us", "_cut")


def _listed(key: str, listed: Sequence[Any], null: bool) -> Column:
    known = F.coalesce(F.col(key).isin(*listed), F.lit(False)) if listed else F.lit(False)
    return known | F.col(key).isNull() if null else known


def _place(df: DataFrame, column: str) -> Column:
    """An ordering column as a long."""
    is_time = isinstance(df.schema[column].dataType, T.TimestampType)
    return micros(column) if is_time else F.col(column).cast("long")


def plan_slices(
    df: DataFrame,
    keys: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
    max_slices: int = MAX_SLICES,
    order: Sequence[str] = ("ts", "seq"),
) -> Slices:
    """Find slice limits for ``df``: a row count per key, then (where some are large) quantiles.

    Reads the keys, then the ordering columns of the large ones.  Brings at most ``MAX_LISTED_KEYS`` keys
    and ``2 * max_slices`` numbers to the driver.
    """
    large = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > rows_per_slice)
        .orderBy(F.desc("_rows")).limit(MAX_LISTED_KEYS + 1).collect()
    )
    if not large:
        return Slices()
    key, listed, null, affected = None, (), False, df
    if len(keys) == 1 and len(large) <= MAX_LISTED_KEYS:
        key = keys[0]
        listed = tuple(row[key] for row in large if row[key] is not None)
        null = any(row[key] is None for row in large)
        affected = df.where(_listed(key, listed, null))
        total = sum(row["_rows"] for row in large)
    else:
        total = df.count() if keys else large[0]["_rows"]
    n = min(max_slices, -(-total // rows_per_slice))
    clock = affected.select(
        _place(df, order[0]).cast("double").alias("us"),
        _place(df, order[1] if len(order) > 1 else order[0]).alias("seq"))
    chosen = Counter(clock.approxQuantile("us", [k / n for k in range(1, n)], 1.0 / (4 * n)))
    times = sorted(int(t) for t in chosen)
    repeated = {int(t): c for t, c in chosen.items() if c > 1}
    busy: dict[int, tuple[int, ...]] = {}
    if repeated:
        most = max(repeated.values())
        grid = [k / (most + 1) for k in range(1, most + 1)]
        rows = (
            clock.where(F.col("us").isin(*map(float, repeated)))
            .groupBy(F.col("us").cast("long").alias("us"))
            .agg(F.percentile_approx("seq", grid, 4 * (most + 1)).alias("limits"))
            .collect()
        )
        for row in rows:
            step = max(1, most // repeated[row["us"]])
            busy[row["us"]] = tuple(sorted(set(row["limits"][::step])))
    return Slices(tuple(times), busy, key, listed, null)


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: Sequence[str],
    local: Callable[[WindowSpec], list[dict[str, Column]]],
    totals: dict[str, Column],
    inherit: Callable[[WindowSpec], list[dict[str, Column]]],
    inherited: str,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    backwards: bool = False,
) -> DataFrame:
    """Add the columns of ``local`` and the ``inherited`` ones (a DDL list) to every row of ``df``.

    ``local`` and ``inherit`` get the ordered window of their level and return column groups, applied one
    after the other so that a later group may use an earlier one.  ``inherit`` must look at preceding
    rows only (in scan direction); with ``backwards`` the scan runs from the last row to the first.
    """
    if slices is None:
        slices = plan_slices(df, keys, rows_per_slice, order=order)
    turn = F.desc if backwards else F.asc
    ordering = [turn(column) for column in order]
    carried = T.StructType.fromDDL(inherited)
    if slices.single:
        rows = _apply(df, local(Window.partitionBy(*keys).orderBy(*ordering)))
        return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in carried.fields})

    # A struct is never NULL, even if its fields are, so rows of a NULL key meet their totals in the join.
    whole = ["_key"] if keys else []
    groups = [*whole, "slice"]
    placed = slices.assign(df, order)
    if keys:
        placed = placed.withColumn("_key", F.struct(*keys))
    rows = _apply(placed, local(Window.partitionBy(*groups).orderBy(*ordering)))
    # With the keys themselves both sides of the join read the same columns, and so the same shuffle.
    per_slice = rows.groupBy(*groups, *keys).agg(*[c.alias(name) for name, c in totals.items()])
    handed = _apply(per_slice, inherit(Window.partitionBy(*whole).orderBy(turn("slice"))))
    return rows.join(handed.select(*groups, *carried.names), groups).drop(*groups)


def _apply(df: DataFrame, groups: list[dict[str, Column]]) -> DataFrame:
    for columns in groups:
        df = df.withColumns(columns)
    return df
