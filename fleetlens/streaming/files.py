"""Small files and folders of a table's own bookkeeping, through the file system that Spark uses for the path."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str) -> tuple[Any, Any]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none where there is no such folder."""
    files, place = _open(spark, folder)
    return [entry.getPath().getName() for entry in files.listStatus(place)] if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all that it holds; nothing happens where there is none."""
    files, place = _open(spark, path)
    files.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    files, place = _open(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under its final name only once it is written whole."""
    files, final = _open(spark, path)
    _, draft = _open(spark, f"{path}.draft")
    stream = files.create(draft, True)
    stream.write(text.encode())
    stream.close()
    files.delete(final, False)  # of an earlier attempt at the same step
    if not files.rename(draft, final):
        raise RuntimeError(f"could not write {path}")
