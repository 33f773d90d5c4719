"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text: an ordinary one on windows of ordinary documents,
and a toxic one, which puts content trained on toxic windows before the same ordinary content, so that the
two lengths of a window differ only where toxic content matches.  Toxic training windows are words that stand
in many different contexts of toxic documents and in few of ordinary ones; counting contexts instead of
documents keeps copies of one document from passing as evidence.

A window is one word between spaces, followed by a fixed pad, as the compressor does not search the last
bytes of its input.  The share of a window's ordinary length that the toxic dictionary saves is compared with
a threshold, calibrated on labelled documents that the dictionaries have not seen; a logistic curve over the
number and density of windows above it, fitted on the same documents, gives the score.

Training reads at most ``SAMPLE`` documents of each label, chosen by a hash of their id, of at most
``SAMPLE_CHARS`` characters each; that bounds what the driver fits on.  Every document is scored whole.

Null and empty texts have no windows and get the score of no toxic window.  Without labelled documents of
both kinds every score is 0.  Labels that are null take no part; of several labels of one document the larger
counts.  Repeated rows are scored each; a null doc_id is scored, and held_out is null.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.tables import map_chunks
from fleetlens.llm.words import hash_spans, word_spans

SAMPLE = 2000
SAMPLE_CHARS = 20_000
FOLDS, HELD_OUT = 3, 1
DECISION = 0.7
DICTIONARY_BYTES = 8192
#: A toxic training window stands in so many contexts at least, or in so large a part of the toxic documents
#: trained on if that is more, and is so many times as frequent as elsewhere.
LEAST_CONTEXTS, LEAST_SHARE, LEAST_RATIO = 3, 0.008, 8.0
CHUNK_BYTES = 8 << 20
REMEMBERED = 2_000_000
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_windows long, n_toxic_windows long"
_WORD = re.compile(r"[a-z0-9\x80-\U0010ffff]+")
_PARAMETERS = dict(
    strategy=zstandard.STRATEGY_LAZY2, min_match=4, window_log=15, hash_log=14, chain_log=14, search_log=5,
    write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)


@dataclass(frozen=True)
class Model:
    """Both dictionaries, the pad after each window, the window threshold and the logistic curve."""

    ordinary: bytes
    toxic: bytes
    pad: bytes
    threshold: float
    weights: tuple[float, ...]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(**_PARAMETERS)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


class Meter:
    """Measures windows with both dictionaries, remembering up to ``REMEMBERED`` of them by hash."""

    def __init__(self, model: Model) -> None:
        self.pad = model.pad
        self.sides = _compressor(model.ordinary), _compressor(model.toxic)
        self.floor = int(self._lengths(self.sides[0], [b"  "])[0])
        self.hashes = np.zeros(0, np.uint64)
        self.shares = np.zeros(0, np.float32)

    def _lengths(self, side: zstandard.ZstdCompressor, windows: list[bytes]) -> np.ndarray:
        data = b"".join(window + self.pad for window in windows)
        sizes = np.fromiter(map(len, windows), np.uint64, len(windows)) + np.uint64(len(self.pad))
        limits = np.stack([np.cumsum(sizes) - sizes, sizes], 1).astype(np.uint64)
        done = side.multi_compress_to_buffer(zstandard.BufferWithSegments(data, limits.tobytes()))
        return np.fromiter(map(len, done), np.int64, len(windows))

    def measure(self, windows: list[bytes]) -> np.ndarray:
        """The share of the ordinary length that the toxic dictionary saves."""
        if not windows:
            return np.zeros(0, np.float32)
        ordinary, toxic = (self._lengths(side, windows) for side in self.sides)
        return ((ordinary - toxic) / np.maximum(ordinary - self.floor, 1)).astype(np.float32)

    def shares_of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The share of every word's window in all rows, and the n + 1 row limits among them."""
        lower, starts, ends, limits = word_spans(column, spaced=False)
        hashes, first, back = np.unique(hash_spans(lower, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        if len(self.hashes):
            known = self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes
        shares = np.zeros(len(hashes), np.float32)
        shares[known] = self.shares[at[known]]
        data = lower.tobytes()
        new = np.flatnonzero(~known)
        for part in np.array_split(new, max(1, len(new) // 20_000)):
            spans = zip(starts[first[part]].tolist(), ends[first[part]].tolist())
            shares[part] = self.measure([b" " + data[a:b] + b" " for a, b in spans])
        if len(self.hashes) + len(new) > REMEMBERED:
            self.hashes, self.shares = hashes, shares
        else:
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
            self.shares = np.insert(self.shares, at[new], shares[new])
        return shares[back], limits


_meters: dict[Model, Meter] = {}


def _meter(model: Model) -> Meter:
    """One meter per process, so that tasks of one executor share what is remembered."""
    if model not in _meters:
        _meters.clear()
        _meters[model] = Meter(model)
    return _meters[model]


def _contexts(texts: list[str]) -> dict[str, int]:
    """For each word, in how many different (word before, word after) contexts it stands."""
    seen = defaultdict(set)
    for text in texts:
        words = ["", *_WORD.findall(text.lower()), ""]
        for before, word, after in zip(words, words[1:], words[2:]):
            seen[word].add((before, after))
    return {word: len(contexts) for word, contexts in seen.items()}


def _trained(samples: list[bytes], size: int) -> bytes:
    """Dictionary content trained on samples; the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _hits(meter: Meter, texts: list[str], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    shares, limits = meter.shares_of(pa.array(texts, pa.string()))
    return _counts(shares, limits, threshold)


def _counts(shares: np.ndarray, limits: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    above = np.concatenate(([0], np.cumsum(shares >= threshold)))
    return above[limits[1:]] - above[limits[:-1]], np.diff(limits)


def _inputs(hits: np.ndarray, windows: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(hits)), np.log1p(hits), np.log1p(100 * hits / np.maximum(windows, 1))], 1)


def fit_logistic(inputs: np.ndarray, labels: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method with a small ridge on all but the constant."""
    weights = np.zeros(inputs.shape[1])
    ridge = penalty * np.eye(inputs.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        step = np.linalg.solve((inputs * (p * (1 - p) + 1e-9)[:, None]).T @ inputs + ridge,
                               inputs.T @ (labels - p) - ridge @ weights)
        weights += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(texts: list[str], labels: list[int]) -> Model | None:
    """Train on one half of each label's texts, calibrate on the other.  None without both labels twice."""
    halves: list[tuple[list[str], list[str]]] = []
    for label in (0, 1):
        own = [text for text, y in zip(texts, labels) if y == label]
        halves.append((own[::2], own[1::2]))
    if not all(half for sides in halves for half in sides):
        return None
    toxic, ordinary = _contexts(halves[1][0]), _contexts(halves[0][0])
    scale = sum(toxic.values()) / max(1, sum(ordinary.values()))
    least = max(LEAST_CONTEXTS, LEAST_SHARE * len(halves[1][0]))
    words = sorted((count, word) for word, count in toxic.items() if count >= least
                   and count >= LEAST_RATIO * scale * (ordinary.get(word, 0) + 0.5))
    lines = [part.encode() for text in halves[0][0] for part in re.findall(r".{1,200}", text.lower(), re.DOTALL)]
    base = _trained(lines, DICTIONARY_BYTES)
    # The most frequent windows go last, where the trainer too puts what is best.
    content = b"".join(b" " + word.encode() + b" " for _, word in words)[-DICTIONARY_BYTES:]
    pad = base[-48:].rjust(48, b".")
    draft = Model(base or b"........", content + base or b"........", pad, 0.5, ())
    meter = Meter(draft)
    seen = halves[0][1] + halves[1][1]
    target = np.array([0] * len(halves[0][1]) + [1] * len(halves[1][1]))
    shares, limits = meter.shares_of(pa.array(seen, pa.string()))
    best = None
    for threshold in (0.5, 0.6, 0.7, 0.8, 0.9):
        inputs = _inputs(*_counts(shares, limits, threshold))
        weights = fit_logistic(inputs, target)
        p = np.clip(1 / (1 + np.exp(-inputs @ weights)), 1e-6, 1 - 1e-6)
        loss = -np.mean(np.where(target == 1, np.log(p), np.log(1 - p)))
        if best is None or loss < best[0] - 1e-9:
            best = (loss, threshold, tuple(weights.tolist()))
    return Model(draft.ordinary, draft.toxic, pad, best[1], best[2])


def _fold(folds: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                    sample: int, chars: int) -> DataFrame:
    """(text, y): at most ``sample`` training documents of each label, none longer than ``chars``."""
    known = (labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y"))
             .where(F.col("y").isin(0, 1)).where(_fold(folds) != held_out)
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = (known.where("y = 0").orderBy(*order).limit(sample)
           .unionByName(known.where("y = 1").orderBy(*order).limit(sample)))
    short = docs.select(F.col("doc_id").cast("long"), "text").where(F.length("text") <= chars)
    # 2 * sample ids of 12 bytes each at most.
    return short.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "y")


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    rows = labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, SAMPLE, SAMPLE_CHARS).distinct().toArrow()
    order = np.lexsort((rows.column("text").to_numpy(zero_copy_only=False),
                        rows.column("doc_id").to_numpy())) if rows.num_rows else []
    rows = rows.take(pa.array(order, pa.int64()))
    return fit(rows.column("text").to_pylist(), rows.column("y").to_pylist())


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document row with its toxicity.  No shuffle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if model is None:
            hits = windows = np.zeros(batch.num_rows, np.int64)
            scores = np.zeros(batch.num_rows)
        else:
            hits, windows = _counts(*_meter(model).shares_of(batch.column("text")), model.threshold)
            scores = 1 / (1 + np.exp(-np.clip(_inputs(hits, windows) @ np.array(model.weights), -30, 30)))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(scores),
             pa.array((scores >= DECISION).astype(np.int32)), pa.array(windows), pa.array(hits)],
            names=[part.split()[0] for part in SCHEMA.split(", ")])

    picked = docs.select(F.col("doc_id").cast("long"), "text").withColumn("held_out", _fold(FOLDS) == HELD_OUT)
    return map_chunks(picked, "text", work, SCHEMA, CHUNK_BYTES)


def without_toxic(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that score below ``DECISION``.  No shuffle."""
    if model is None:
        return docs

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        inputs = _inputs(*_counts(*_meter(model).shares_of(batch.column("text")), model.threshold))
        scores = 1 / (1 + np.exp(-np.clip(inputs @ np.array(model.weights), -30, 30)))
        return batch.filter(pa.array(scores < DECISION))

    return map_chunks(docs, "text", work, docs.schema, CHUNK_BYTES)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
