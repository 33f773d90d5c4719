"""Small helpers shared by the operators: reading tables, Arrow batches, cutting lineage.

Operators keep to DataFrames; their per-batch helpers run in :meth:`DataFrame.mapInArrow`, a bounded number
of text bytes at a time.  :func:`ship` gives this package to the Python workers.
"""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fleetlens.plans.session import settle, shared_dir

#: Text bytes that a helper holds at once, unless one row alone is longer.
CHUNK_BYTES = 4 << 20

__all__ = ["CHUNK_BYTES", "chunks", "map_chunks", "read_table", "release", "settle", "shared_dir", "ship", "string_bytes"]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    if package.is_dir():  # else it came as a file of Spark's already
        archive = Path(tempfile.mkdtemp(prefix="fleetlens-")) / "fleetlens.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of results that nothing refers to any more.

    Its cleaner waits for a garbage collection on the driver, which a job of many small steps may not see for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices whose text column has at most ``limit`` bytes, one row at least."""
    sizes = batch.column(column).cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset:sizes.offset + len(sizes) + 1]
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def map_chunks(df: DataFrame, column: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
               schema: str | StructType, limit: int = CHUNK_BYTES) -> DataFrame:
    """``mapInArrow`` with ``work`` on slices of bounded text size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, column, limit):
                made = work(part)
                if made is not None and made.num_rows:
                    yield made

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, nulls as empty, and the n + 1 row limits in them."""
    filled = column.cast(pa.large_string()).fill_null("")
    limits = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset:filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[limits[0]:limits[-1]], limits - limits[0]
