"""Fill-in-the-middle: texts are cut at two unit limits and their parts rearranged around three markers.

A unit is a line with its line break.  Which documents are cut, where, and in which order their parts are put
follows from a hash of their id, so every run and every partition decides alike.  Per text a Fenwick tree over
fixed blocks of bytes holds the units and the code points of the blocks; a cut is found by binary-lifting descent
to its block, and only that block is then searched for the line break.

Texts that hold a marker are left plain, so the parts can be read back from the output without fail.

A null text is empty, and an empty text is plain with no units.  Repeated rows are handled each, a null doc_id is
hashed as an empty one, other columns take no part; an empty table gives an empty one.  A long text costs its own
length, a cut in it the logarithm of its blocks and one block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.llm.tables import map_chunks, string_bytes

# The markers.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SUFFIX_FIRST = 7, 100, 50
BLOCK = 4096
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_NEWLINE = 10


def fenwick(values: np.ndarray) -> np.ndarray:
    """Fenwick tree of ``values``: entry i (from 1) holds the sum of the values i - lowbit(i) to i - 1."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    place = np.arange(len(total))
    return total - total[place - (place & -place)]


def descend(units: np.ndarray, points: np.ndarray, wanted: int) -> tuple[int, int, int]:
    """The block that holds unit end number ``wanted`` (from 1): its number, and the units and points before it."""
    block = before = chars = 0
    step = 1 << (len(units) - 1).bit_length()
    while step:
        ahead = block + step
        if ahead < len(units) and before + units[ahead] < wanted:
            block, before, chars = ahead, before + int(units[ahead]), chars + int(points[ahead])
        step >>= 1
    return block, before, chars


class Lines:
    """The line limits of one UTF-8 text through a Fenwick tree over its blocks."""

    def __init__(self, data: np.ndarray, block: int = BLOCK) -> None:
        self.data, self.block = data, block
        starts = np.arange(0, len(data), block)
        ends, heads = data == _NEWLINE, (data & 0xC0) != 0x80
        unit_counts = np.add.reduceat(ends, starts, dtype=np.int64) if len(data) else np.zeros(0, np.int64)
        if len(data) and not ends[-1]:
            unit_counts[-1] += 1  # the last line ends with the text
        point_counts = np.add.reduceat(heads, starts, dtype=np.int64) if len(data) else np.zeros(0, np.int64)
        self.n = int(unit_counts.sum())
        self.units, self.points = fenwick(unit_counts), fenwick(point_counts)

    def cut(self, after: int) -> tuple[int, int]:
        """Bytes and code points of the first ``after`` units."""
        if after == 0:
            return 0, 0
        block, before, chars = descend(self.units, self.points, after)
        here = self.data[block * self.block:(block + 1) * self.block]
        breaks = np.flatnonzero(here == _NEWLINE)
        rest = after - before - 1
        inside = int(breaks[rest]) + 1 if rest < len(breaks) else len(here)
        return block * self.block + inside, chars + int(((here[:inside] & 0xC0) != 0x80).sum())


def choices(doc_id: int | None, seed: int = SEED) -> list[int]:
    """The four numbers that decide about a document."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[8 * k:8 * k + 8], 16) for k in range(4)]


def rearrange(data: np.ndarray, doc_id: int | None, seed: int = SEED, rate: int = RATE,
              suffix_first: int = SUFFIX_FIRST, block: int = BLOCK) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and middle, and the output of one text."""
    lines, raw = Lines(data, block), data.tobytes()
    first, second, cut, order = choices(doc_id, seed)
    if not raw or cut % 100 >= rate or any(m.encode() in raw for m in (PREFIX, SUFFIX, MIDDLE)):
        return lines.n, "plain", None, None, raw
    low, high = sorted((first % (lines.n + 1), second % (lines.n + 1)))
    (a, chars_a), (b, chars_b) = lines.cut(low), lines.cut(high)
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    if order % 100 < suffix_first:
        form, parts = "spm", ((SUFFIX, suffix), (PREFIX, prefix), (MIDDLE, middle))
    else:
        form, parts = "psm", ((PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle))
    return lines.n, form, chars_a, chars_b - chars_a, b"".join(m.encode() + part for m, part in parts)


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs`` (doc_id, text).

    ``rate`` of 100 documents are cut, ``suffix_first`` of 100 of those put the suffix first (form ``spm``).
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, limits = string_bytes(batch.column("text"))
        ids = batch.column("doc_id").to_pylist()
        rows = [rearrange(data[limits[i]:limits[i + 1]], doc_id, seed, rate, suffix_first) for i, doc_id in enumerate(ids)]
        n, form, prefix, middle, output = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(form, pa.string()),
             pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_chunks(whole, "text", run, SCHEMA)


def read_back(output: Column, form: Column) -> Column:
    """The text that an output of the given form was made of."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, middle = F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.get(parts, F.lit(3))
    return F.when(form == "psm", F.concat(first, middle, second)).when(
        form == "spm", F.concat(second, middle, first)).otherwise(output)


def digests(made: DataFrame) -> DataFrame:
    """The result of :func:`fill_in_middle` with hashes in place of texts: of the output, and of what it reads back to."""
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(read_back(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))
