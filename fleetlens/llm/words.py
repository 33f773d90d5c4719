"""Words of UTF-8 texts as 64-bit hashes, and hashes of word runs, with numpy on whole Arrow batches.

Two definitions of a word: between the six ASCII white spaces (``spaced=True``), with A-Z lower-cased only;
or a run of ASCII letters, digits and non-ASCII characters, with the capitals of Latin-1 lower-cased too.
Hashes are polynomials over the bytes modulo 2**64 with a final mix; equal words have equal hashes.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa

from fleetlens.llm.tables import string_bytes

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run ``values[start:end]`` that depends on its content and order only."""
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_ODD, len(values)), out=prefix[1:])
    raw = (prefix[ends] - prefix[starts]) * _powers(_INVERSE, len(values) + 1)[starts]
    return mix(raw ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def word_spans(column: pa.Array, spaced: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all rows, starts and ends of the words in them, and n + 1 row limits among words."""
    data, limits = string_bytes(column)
    if not len(data):
        none = np.zeros(0, np.int64)
        return data, none, none, np.zeros(len(limits), np.int64)
    lower = data.copy()
    lower[(data >= 65) & (data <= 90)] += 32
    if spaced:
        inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    else:
        inside = ((lower >= 97) & (lower <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)
        after = np.flatnonzero(data[:-1] == 0xC3) + 1
        capital = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
        lower[capital] += 32
    edge = np.zeros(len(data) + 1, bool)
    edge[limits] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    following = np.concatenate((inside[1:], [False]))
    ends = np.flatnonzero(inside & (~following | edge[1:])) + 1
    return lower, starts, ends, np.searchsorted(starts, limits)


def hash_spans(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return run_hashes(_BYTE_VALUES[lower], starts, ends)


def words_of(column: pa.Array, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows one after another, and the n + 1 row limits among them."""
    lower, starts, ends, limits = word_spans(column, spaced)
    return hash_spans(lower, starts, ends), limits


def row_numbers(limits: np.ndarray) -> np.ndarray:
    """For each word, the row it stands in."""
    return np.repeat(np.arange(len(limits) - 1), np.diff(limits))
