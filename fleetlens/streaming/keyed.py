"""Tables with one current row per key, kept up to date by micro-batches.

Rows are dealt to buckets by a hash of their key.  A merge reads only the buckets that its changes fall into,
writes them anew into a folder of its own, and then switches to a new manifest, which names for every bucket the
folder that holds it.  So readers see one version or the next, never a mixture, and the table's size follows the
number of keys and not the number of merges: what neither the new manifest nor the one before names is removed,
so a reader has the time of one more merge to finish.

Version ``n`` is made by micro-batch ``n`` from the newest version before it.  A replay of ``n`` starts from the
same version, writes a folder of its own and replaces the manifest, so it counts once.

Files and manifests are read and written through the file system of ``path``, as Spark's own are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from fleetlens.streaming import files
from fleetlens.streaming.sinks import _each_batch

BUCKETS = 16

#: From the names of the value columns to their aggregates over the rows of a key; column ``_new`` marks changes.
Combine = Callable[[list[str]], dict[str, Column]]


def newest(values: list[str]) -> dict[str, Column]:
    """The changed row in place of the old one."""
    row = F.max_by(F.struct(*values), "_new")
    return {name: row[name] for name in values}


@dataclass(frozen=True)
class KeyedTable:
    """The table under ``path`` with one row per value of ``keys``; ``buckets`` is fixed by the first merge."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = BUCKETS

    def versions(self) -> list[int]:
        """The versions that can be read, oldest first."""
        return sorted(int(name.removesuffix(".json")) for name in files.names(
            self.spark, f"{self.path}/manifests") if name.endswith(".json"))

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, by default the newest one; None where there is none."""
        known = self.versions()
        if version is None and known:
            version = known[-1]
        return None if version not in known else self._rows(self._manifest(version))

    def read_before(self, n: int) -> DataFrame | None:
        """The newest version that micro-batch ``n`` may build on."""
        return self.read(self._before(n)) if self._before(n) is not None else None

    def merge(self, changes: DataFrame, n: int, combine: Combine = newest) -> None:
        """Make version ``n``: rows of ``changes`` and the old rows of their keys are combined per key."""
        before = self._before(n)
        old = None if before is None else self._manifest(before)
        buckets = self.buckets if old is None else old["buckets"]
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")
        placed = changes.withColumn("_bucket", bucket).persist()
        try:
            touched = sorted(row[0] for row in placed.select("_bucket").distinct().collect())  # at most ``buckets``
            folder = f"{n}-{uuid.uuid4().hex}"
            folders = dict(old["folders"]) if old else {}
            values = [c for c in changes.columns if c not in self.keys]
            schema = changes.schema if old is None else StructType.fromJson(json.loads(old["schema"]))
            rows = placed.withColumn("_new", F.lit(True))
            if old and (held := [b for b in touched if str(b) in folders]):
                there = self._rows(old, held).withColumn("_bucket", bucket).withColumn("_new", F.lit(False))
                rows = rows.unionByName(there)
            if touched:
                # one shuffle: rows of a bucket meet, and the keys of a bucket lie in it
                merged = rows.repartition(len(touched), "_bucket").groupBy("_bucket", *self.keys).agg(
                    *[c.alias(name) for name, c in combine(values).items()]).select("_bucket", *changes.columns)
                schema = merged.drop("_bucket").schema
                merged.write.partitionBy("_bucket").parquet(f"{self.path}/rows/{folder}")
            folders |= {str(b): folder for b in touched}
            files.publish_text(self.spark, f"{self.path}/manifests/{n}.json", json.dumps(
                {"buckets": buckets, "folders": folders, "schema": schema.json()}))
        finally:
            placed.unpersist()
        self._remove_unused(n, before)

    def _before(self, n: int) -> int | None:
        return max((v for v in self.versions() if v < n), default=None)

    def _rows(self, manifest: dict[str, Any], only: list[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        places = [f"{self.path}/rows/{folder}/_bucket={b}" for b, folder in manifest["folders"].items()
                  if only is None or int(b) in only]
        if not places:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*places)

    def _manifest(self, version: int) -> dict[str, Any]:
        return json.loads(files.read_text(self.spark, f"{self.path}/manifests/{version}.json"))

    def _remove_unused(self, n: int, before: int | None) -> None:
        """Remove what neither version ``n`` nor the one before it names."""
        kept = [v for v in (before, n) if v is not None]
        used = {folder for v in kept for folder in self._manifest(v)["folders"].values()}
        for version in self.versions():
            if version not in kept and version < n:
                files.remove(self.spark, f"{self.path}/manifests/{version}.json")
        for folder in files.names(self.spark, f"{self.path}/rows"):
            if folder not in used and int(folder.split("-")[0]) <= n:
                files.remove(self.spark, f"{self.path}/rows/{folder}")


def write_upserts(df: DataFrame, path: str, checkpoint: str, keys: list[str], buckets: int = BUCKETS,
                  drain: bool = False) -> StreamingQuery:
    """The changed rows of a running aggregate into a :class:`KeyedTable`; see :func:`read_upserts`."""

    def act(batch: DataFrame, n: int) -> None:
        KeyedTable(batch.sparkSession, path, tuple(keys), buckets).merge(batch, n)

    return _each_batch(df, "update", act, checkpoint, drain)


def read_upserts(spark: SparkSession, path: str, keys: list[str], version: int | None = None) -> DataFrame:
    """The current rows of a table written by :func:`write_upserts`, or those of a version that is still kept."""
    rows = KeyedTable(spark, path, tuple(keys)).read(version)
    if rows is None:
        raise ValueError(f"no such version of {path}")
    return rows
