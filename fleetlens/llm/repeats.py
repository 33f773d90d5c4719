"""Passages that repeat, by a sparse suffix array over words.

Only suffixes at minimiser positions are kept: a position whose hash of ``SEED`` words is the smallest of a window
of neighbouring ones.  Positions depend on content alone, so copies of a passage keep the same ones, and each run of
``length`` words holds one among its first window of words.  Suffixes are sorted by their head, the words that every
such run has from there on (a range-partitioned sort; ties by text and place, so a crowd of equal suffixes spreads
over tasks) and compared with their neighbours.  Suffixes that agree with none are done.

The others are extended left and right.  A suffix's context is what all passages of ``length`` words that have
it as their first kept position can reach.  Suffixes of equal context repeat in all these passages.  Where suffixes
of one head have several contexts and one of them stands alone, the single passages of one suffix of each context
are counted.  A word is in the result if some passage of ``length`` words around it stands at two places or more,
in one document or several.

Equal texts are one text here, and its documents are reported whole.  Words are runs between white spaces, A-Z
lower-cased.  Null, empty and short texts have no passage; null doc_ids take no part; rows of one id and text
count once, and an id with several texts counts as a document for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.tables import map_chunks, settle
from fleetlens.llm.words import row_numbers, run_hashes, words_of

LENGTH, SEED = 50, 8


def minimisers(words: np.ndarray, limits: np.ndarray, seed: int, window: int) -> np.ndarray:
    """Positions of the smallest seed hash of each window of ``window`` seeds; the first one of equals."""
    count = len(words) - seed + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    at = np.arange(count)
    hashes = run_hashes(words, at, at + seed)
    ends = np.repeat(limits[1:], np.diff(limits))[:count]
    whole = at + seed + window - 1 <= ends
    begins = at[whole]
    if not len(begins):
        return begins
    # Place of the smallest among the next ``window`` seeds, by doubling.
    best, span = at.copy(), 1
    while span < window:
        step = min(span, window - span)
        other = best[np.minimum(at + step, count - 1)]
        best = np.where(hashes[other] < hashes[best], other, best)
        span += step
    return np.unique(best[begins])


def window_of(length: int) -> int:
    """How many neighbouring seeds a minimiser is the smallest of."""
    return (length - SEED) // 2


_SUFFIX = "head long, text_id long, at long, context long, low long, high long"


def _suffixes(texts: DataFrame, length: int) -> DataFrame:
    """Each kept suffix by the hash of its head, with the hash and the limits of its context."""
    window = window_of(length)
    head = length - window + 1

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        words, limits = words_of(batch.column("text"), spaced=True)
        at = minimisers(words, limits, SEED, window)
        row = row_numbers(limits)[at] if len(at) else at
        fits = at + head <= limits[row + 1] if len(at) else np.zeros(0, bool)
        at, row = at[fits], row[fits]
        if not len(at):
            return None
        low = np.maximum(at - window + 1, limits[row])
        high = np.minimum(at + length, limits[row + 1])
        context = run_hashes(words, low, high).view(np.int64) ^ ((at - low) << 7)
        return pa.RecordBatch.from_arrays(
            [pa.array(run_hashes(words, at, at + head).view(np.int64)), batch.column("text_id").take(pa.array(row)),
             *map(pa.array, (at - limits[row], context, low - limits[row], high - limits[row]))],
            names=[part.split()[0] for part in _SUFFIX.split(", ")])

    return map_chunks(texts, "text", work, _SUFFIX)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes whose head is that of a neighbour, and both ends of a partition, whose neighbours are not known.

    Copies of a text give equal rows, of which one is kept.
    """
    held: pa.Table | None = None  # the last row so far, and whether it agreed with the one before
    agreed = True
    for batch in batches:
        if not batch.num_rows:
            continue
        fresh = pa.Table.from_batches([batch])
        rows = fresh if held is None else pa.concat_tables([held, fresh])
        head, text, at = (rows.column(c).to_numpy() for c in ("head", "text_id", "at"))
        new = np.concatenate(([True], (head[1:] != head[:-1]) | (text[1:] != text[:-1]) | (at[1:] != at[:-1])))
        rows, head = rows.filter(pa.array(new)), head[new]
        same = np.concatenate(([agreed], head[1:] == head[:-1]))
        kept = same[:-1] | same[1:]
        agreed = bool(same[-1])
        yield from rows.slice(0, rows.num_rows - 1).filter(pa.array(kept)).combine_chunks().to_batches()
        held = rows.slice(rows.num_rows - 1)
    if held is not None:
        yield from held.combine_chunks().to_batches()


def _passages(texts: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """(text_id, at, passage): each passage whose first kept position can be one of the places of a text."""
    window = window_of(length)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, limits = words_of(batch.column("text"), spaced=True)
        lists = batch.column("places")
        row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets, np.int64)))
        begin = np.asarray(lists.flatten(), np.int64) + limits[row]
        begin = (begin[:, None] - np.arange(window)).ravel()
        row = np.repeat(row, window)
        fits = (begin >= limits[row]) & (begin + length <= limits[row + 1])
        begin, first = np.unique(begin[fits], return_index=True)
        row = row[fits][first]
        return pa.RecordBatch.from_arrays(
            [batch.column("text_id").take(pa.array(row)), pa.array(begin - limits[row]),
             pa.array(run_hashes(words, begin, begin + length).view(np.int64))], names=["text_id", "at", "passage"])

    # A text has fewer places than words.
    wanted = places.groupBy("doc_id", "text_id").agg(F.collect_set("at").alias("places"))
    return map_chunks(texts.join(wanted, ["doc_id", "text_id"]), "text", work, "text_id long, at long, passage long")


def _joined(spans: DataFrame) -> DataFrame:
    """Spans of each text with those that touch joined; a group is the spans of one text."""
    def work(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("start")
        start, end = rows.column("start").to_numpy(), np.maximum.accumulate(rows.column("end").to_numpy())
        first = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
        last = np.concatenate((first[1:], [len(start)])) - 1
        return pa.table({"text_id": pa.array(np.full(len(first), rows.column("text_id")[0].as_py()), pa.int64()),
                         "start": pa.array(start[first]), "end": pa.array(end[last])})

    return spans.groupBy("text_id").applyInArrow(work, "text_id long, start long, end long")


def repeated_passages(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, end, n_words): the stretches of words of each document that repeat elsewhere.

    ``start`` and ``end`` count words.  Every document with a repeated passage has a row, copies too.
    """
    if length < SEED + 2:
        raise ValueError(f"length must be {SEED + 2} at least")
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_id"), "text").where(
        "doc_id is not null and text is not null")
    every = settle(map_chunks(texts, "text", _counted, "doc_id long, text_id long, n_words long"))
    known = every.distinct().groupBy("text_id").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"))
    order = ["head", "text_id", "at"]
    ordered = _suffixes(texts, length).repartitionByRange(*order).sortWithinPartitions(*order)
    suffixes = settle(ordered.mapInArrow(_agreeing, _SUFFIX))
    groups = suffixes.groupBy("head", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("text_id", "at")).alias("one"))
    groups = settle(groups)
    crowded = groups.where("n > 1").select("head", "context")
    alike = suffixes.where(F.col("high") - F.col("low") >= length).join(
        crowded, ["head", "context"], "left_semi").select(
        "text_id", F.col("low").alias("start"), F.col("high").alias("end"))
    open_heads = groups.groupBy("head").agg(F.count("*").alias("contexts"), F.min("n").alias("least")).where(
        "contexts > 1 and least = 1").select("head")
    places = groups.join(open_heads, "head", "left_semi").select("one.text_id", "one.at").join(
        known.select("text_id", "doc_id"), "text_id")
    passages = settle(_passages(texts, places, length).distinct())
    often = passages.groupBy("passage").agg(F.count("*").alias("n")).where("n > 1").select("passage")
    single = passages.join(often, "passage", "left_semi").select(
        "text_id", F.col("at").alias("start"), (F.col("at") + length).alias("end"))
    spans = _joined(alike.unionByName(single))
    own = spans.join(known.where("copies = 1"), "text_id").select("doc_id", "start", "end")
    copied = known.where((F.col("copies") > 1) & (F.col("n_words") >= length)).select("text_id")
    whole = every.distinct().join(copied, "text_id", "left_semi").select(
        "doc_id", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"))
    return own.unionByName(whole).withColumn("n_words", F.col("end") - F.col("start"))


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    _, limits = words_of(batch.column("text"), spaced=True)
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_id"), pa.array(np.diff(limits))],
                                      names=["doc_id", "text_id", "n_words"])
