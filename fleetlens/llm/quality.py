"""Document quality by a linear-chain conditional random field over lines.

Every line gets a state, good or bad.  A line's features are shares of capitals, symbols, digits, repeated and
unworded parts and the like, of itself and of both neighbouring lines; the chain adds how well states follow
each other.  Weights maximise the likelihood of labelled documents whose lines carry the document's label.
Forward-backward marginals, weighted by the lines' lengths, make one number per document, and a logistic curve
fitted on labelled documents that the field has not seen turns it into the score.

Training reads at most ``SAMPLE`` documents of each label, chosen by a hash of their id, of at most
``SAMPLE_CHARS`` characters and ``SAMPLE_LINES`` lines each.  Every document is scored whole.

A null or empty text is one empty line.  Without labelled documents of both kinds every score is 0.5.  Labels
that are null take no part.  Repeated rows are scored each; a null doc_id is scored, and held_out is null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.tables import map_chunks
from fleetlens.llm.toxicity import fit_logistic, labelled_sample
from fleetlens.llm.words import hash_spans, mix, run_hashes, word_spans

SAMPLE = 800
SAMPLE_CHARS, SAMPLE_LINES = 20_000, 200
FOLDS, HELD_OUT = 5, 0
DECISION = 0.3
STEPS, RATE, PENALTY = 120, 0.1, 1e-3
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_lines long, good_share double"
OWN = ("log_words", "capitals", "symbols", "digits", "distinct", "repeats", "decorated", "bare", "word_length",
       "ends", "starts", "seen_before")


@dataclass(frozen=True)
class Field:
    """Scaling and weights of the features for state good, transition scores and the logistic curve."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray  # 2 x 2, from bad or good to bad or good
    curve: np.ndarray


def _shares(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray, of: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (total[ends] - total[starts]) / np.maximum(of, 1)


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of all rows, their lengths in bytes, and the n + 1 row limits among lines."""
    data_rows = column.cast(pa.large_string()).fill_null("")
    lower, starts, ends, word_limits = word_spans(data_rows, spaced=True)
    offsets = np.frombuffer(data_rows.buffers()[1], np.int64)[data_rows.offset:data_rows.offset + len(data_rows) + 1]
    raw = data_rows.buffers()[2]
    data = (np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None and raw.size
            else np.zeros(0, np.uint8))
    offsets = offsets - offsets[0]
    # A row with k line ends has k + 1 lines; a line end on a row's last place makes an empty last line.
    breaks = np.flatnonzero(data == 10)
    row_of_break = np.searchsorted(offsets, breaks, side="right") - 1
    line_starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    counts = 1 + np.bincount(row_of_break, minlength=len(offsets) - 1)
    limits = np.concatenate(([0], np.cumsum(counts)))
    # Starts are sorted by place; rows of no text share places with their neighbours, so ends go by row.
    row = np.repeat(np.arange(len(offsets) - 1), counts)
    first = limits[:-1]
    line_starts = np.empty(limits[-1], np.int64)
    line_starts[first] = offsets[:-1]
    rest = np.ones(limits[-1], bool)
    rest[first] = False
    line_starts[rest] = breaks + 1
    line_ends = np.empty(limits[-1], np.int64)
    last = limits[1:] - 1
    line_ends[last] = offsets[1:]
    rest = np.ones(limits[-1], bool)
    rest[last] = False
    line_ends[rest] = breaks
    size = line_ends - line_starts

    ascii_capital = (data >= 65) & (data <= 90)
    lead = np.concatenate(([0], data[:-1])) == 0xC3 if len(data) else np.zeros(0, bool)
    capital = ascii_capital | (lead & (data >= 0x80) & (data <= 0x9E) & (data != 0x97))
    letter = ascii_capital | ((data >= 97) & (data <= 122)) | (data >= 0xC0)
    digit = (data >= 48) & (data <= 57)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    symbol = ~(letter | digit | space | (data >= 128))
    letters = _shares(letter, line_starts, line_ends, np.ones(len(size)))

    at, upto = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    words = upto - at
    hashes = hash_spans(lower, starts, ends)
    line_of_word = np.repeat(np.arange(len(size)), words)
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (line_of_word[1:] == line_of_word[:-1])
    key = mix(hashes ^ (line_of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    _, once = np.unique(key, return_index=True)
    new_word = np.zeros(len(starts), bool)
    new_word[once] = True
    symbols = np.concatenate(([0], np.cumsum(symbol, dtype=np.int64)))
    signs = symbols[ends] - symbols[starts]
    tail = np.zeros(len(starts), bool)  # two signs at the end of a longer word
    long_word = ends - starts >= 3
    tail[long_word] = symbol[ends[long_word] - 1] & symbol[ends[long_word] - 2]
    bare = signs == ends - starts

    lines = run_hashes(hashes, at, upto)
    key = mix(lines ^ (row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    _, once = np.unique(key, return_index=True)
    seen = np.ones(len(size), bool)
    seen[once] = False
    seen &= words > 0

    ends_well = np.zeros(len(size), bool)
    begins_well = np.zeros(len(size), bool)
    filled = words > 0
    closing = data[ends[upto[filled] - 1] - 1] if len(data) else np.zeros(0, np.uint8)
    ends_well[filled] = np.isin(closing, np.frombuffer(b".!?:;\"')", np.uint8))
    opening = starts[at[filled]]
    begins_well[filled] = capital[opening] | capital[np.minimum(opening + 1, max(len(data) - 1, 0))]
    own = np.stack([
        np.log1p(words), _shares(capital, line_starts, line_ends, letters),
        _shares(symbol, line_starts, line_ends, size), _shares(digit, line_starts, line_ends, size),
        _shares(new_word, at, upto, words), _shares(same, at, upto, words), _shares(tail, at, upto, words),
        _shares(bare, at, upto, words), np.minimum(_shares(ends - starts, at, upto, words) / 10, 5),
        ends_well, begins_well, seen], 1).astype(np.float64)
    before, after = np.zeros_like(own), np.zeros_like(own)
    inner = row[1:] == row[:-1]
    before[1:][inner] = own[:-1][inner]
    after[:-1][inner] = own[1:][inner]
    return np.concatenate([own, before, after], 1), size, limits


def marginals(scores: np.ndarray, limits: np.ndarray, moves: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all sequences at once.

    Gives the marginal of state good per line, the expected moves per sequence (n x 2 x 2) and the log of the
    partition sum per sequence.  ``scores`` are those of state good; state bad has 0.
    """
    lengths = np.diff(limits)
    order = np.argsort(-lengths, kind="stable")
    first, lengths = limits[:-1][order], lengths[order]
    n, longest = len(lengths), int(lengths.max(initial=0))
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # sequences longer than t
    forward = np.zeros((len(scores), 2))
    state = np.zeros((n, 2))
    for t in range(longest):
        k = active[t]
        at = first[:k] + t
        if t:
            old = state[:k]
            state[:k] = np.logaddexp(old[:, :1] + moves[0], old[:, 1:] + moves[1])
        state[:k, 1] += scores[at]
        forward[at] = state[:k]
    total = np.logaddexp(state[:, 0], state[:, 1])
    good = np.zeros(len(scores))
    moved = np.zeros((n, 2, 2))
    back = np.zeros((n, 2))
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        follows = active[t + 1] if t + 1 < longest else 0
        if follows:
            nxt = first[:follows] + t + 1
            ahead = back[:follows].copy()
            ahead[:, 1] += scores[nxt]
            both = (forward[nxt - 1][:, :, None] + moves[None] + ahead[:, None, :]
                    - total[:follows, None, None])
            moved[:follows] += np.exp(both)
            back[:follows] = np.logaddexp(ahead[:, :1] + moves[:, 0], ahead[:, 1:] + moves[:, 1])
        back[follows:k] = 0.0
        good[at] = np.exp(forward[at, 1] + back[:k, 1] - total[:k])
    undo = np.empty(n, np.int64)
    undo[order] = np.arange(n)
    return good, moved[undo], total[undo]


def _weighted(good: np.ndarray, size: np.ndarray, limits: np.ndarray) -> np.ndarray:
    weight = np.maximum(size, 1).astype(np.float64)
    return np.add.reduceat(good * weight, limits[:-1]) / np.add.reduceat(weight, limits[:-1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit(texts: list[str], labels: list[int]) -> Field | None:
    """Weights from one half of each label's texts, the curve from the other.  None without both labels twice."""
    target = np.array(labels)
    if any((target == y).sum() < 2 for y in (0, 1)):
        return None
    features, size, limits = line_features(pa.array(texts, pa.string()))
    short = np.diff(limits) <= SAMPLE_LINES
    half = np.zeros(len(texts), bool)
    for y in (0, 1):
        half[np.flatnonzero(target == y)[::2]] = True
    centre, scale = features.mean(0), features.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)

    def part(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        lines = np.repeat(chosen, np.diff(limits))
        counts = np.diff(limits)[chosen]
        rows = np.hstack([(features[lines] - centre) / scale, np.ones((lines.sum(), 1))])
        return rows, size[lines], np.concatenate(([0], np.cumsum(counts))), target[chosen]

    rows, _, bounds, y = part(half & short)
    per_line = np.repeat(y, np.diff(bounds))
    wanted_moves = np.zeros((2, 2))
    for state in (0, 1):
        wanted_moves[state, state] = (np.diff(bounds)[y == state] - 1).sum()
    wanted = rows.T @ per_line
    weights, moves = np.zeros(rows.shape[1]), np.zeros((2, 2))
    count = max(1, len(y))
    first = [np.zeros_like(weights), np.zeros_like(moves)]
    second = [np.zeros_like(weights), np.zeros_like(moves)]
    for step in range(1, STEPS + 1):
        good, moved, _ = marginals(rows @ weights, bounds, moves)
        slopes = [(wanted - rows.T @ good) / count - PENALTY * weights,
                  (wanted_moves - moved.sum(0)) / count - PENALTY * moves]
        for k, (value, slope) in enumerate(zip((weights, moves), slopes)):
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope ** 2
            value += RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    rows, sizes, bounds, y = part(~half)
    share = _weighted(marginals(rows @ weights, bounds, moves)[0], sizes, bounds)
    curve = fit_logistic(np.stack([np.ones(len(share)), _logit(share)], 1), y)
    return Field(centre, scale, weights, moves, curve)


def score_texts(field: Field | None, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, number of lines and length-weighted share of good lines per row."""
    features, size, limits = line_features(column)
    if field is None:
        return np.full(len(column), 0.5), np.diff(limits), np.full(len(column), 0.5)
    rows = (features - field.centre) / field.scale
    good, _, _ = marginals(rows @ field.weights[:-1] + field.weights[-1], limits, field.moves)
    share = _weighted(good, size, limits)
    z = field.curve[0] + field.curve[1] * _logit(share)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30))), np.diff(limits), share


def train(docs: DataFrame, labels: DataFrame) -> Field | None:
    rows = labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, SAMPLE, SAMPLE_CHARS).distinct().toPandas()
    rows = rows.sort_values(["doc_id", "text"])
    return fit(rows["text"].tolist(), rows["y"].tolist())


def score(docs: DataFrame, field: Field | None) -> DataFrame:
    """One row per document row with its quality.  No shuffle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, lines, share = score_texts(field, batch.column("text"))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(scores),
             pa.array((scores >= DECISION).astype(np.int32)), pa.array(lines.astype(np.int64)), pa.array(share)],
            names=[part.split()[0] for part in SCHEMA.split(", ")])

    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    picked = docs.select(F.col("doc_id").cast("long"), "text").withColumn("held_out", fold == HELD_OUT)
    return map_chunks(picked, "text", work, SCHEMA)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
