"""Benchmark decontamination with spaced seeds.

Masks of kept and ignored places slide over the words of both sides; equal hashes of the kept words are hits, so
a replaced word on an ignored place does no harm.  Test seeds first mark a bit map of bounded size, two bits each.  Document
positions whose seed is not marked go no further; around the others a stretch of words is kept, and equal
stretches of different documents are one.  Seeds of the stretches are then joined with the test seeds, and on
each diagonal with a hit the aligned words are compared: document and item overlap if some ``SPAN`` aligned
words in a row (or all of a shorter item) hold a hit and differ in no more than ``TOLERANCE`` of them.

Words are runs of letters, digits and non-ASCII characters, lower-cased.  Items of fewer words than the
shortest mask cannot be told from chance and are not looked for.  Null texts have no words.  Null ids take no
part.  Repeated rows count once; rows of one id with different texts each count.  Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.tables import map_chunks, settle
from fleetlens.llm.words import mix, row_numbers, run_hashes, words_of

#: Kept (1) and ignored (0) places.  The first mask is solid and serves short items.
MASKS = ("11111111", "110110101011", "111001011011", "101101110011")
SPAN, TOLERANCE = 13, 0.2
#: Bits of the map per test seed, and its greatest size (2**26 bits are 8 MB).  A seed sets two bits.
BITS_PER_SEED, MOST_BITS = 1024, 1 << 26
LEAST_BITS = 1 << 16
_REACH = SPAN + max(map(len, MASKS))
_STRETCH = "doc_id long, start long, stretch long, words array<long>"


def seeds_of(words: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, mask and hash of every seed that lies within one row."""
    ends = np.repeat(limits[1:], np.diff(limits))
    places, masks, hashes = [], [], []
    for m, mask in enumerate(MASKS):
        at = np.flatnonzero(np.arange(len(words)) + len(mask) <= ends)
        value = np.full(len(at), m + 1, np.uint64)
        for k, kept in enumerate(mask):
            if kept == "1":
                value += words[at + k] * np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 3, 1 << 64))
        places.append(at)
        masks.append(np.full(len(at), m))
        hashes.append(mix(value))
    return np.concatenate(places), np.concatenate(masks), np.concatenate(hashes)


def _item_seeds(benchmark: DataFrame) -> DataFrame:
    """(item_id, place, hash, words): every seed of every item of enough words."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, limits = words_of(batch.column("text"), spaced=False)
        places, _, hashes = seeds_of(words, limits)
        row = row_numbers(limits)[places]
        return pa.RecordBatch.from_arrays(
            [batch.column("item_id").take(pa.array(row)), pa.array(places - limits[row]),
             pa.array(hashes.astype(np.int64))], names=["item_id", "place", "hash"])

    return map_chunks(benchmark, "text", work, "item_id long, place long, hash long")


def _item_words(benchmark: DataFrame) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, limits = words_of(batch.column("text"), spaced=False)
        return pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.LargeListArray.from_arrays(
                pa.array(limits), pa.array(words.astype(np.int64))).cast(pa.list_(pa.int64()))],
            names=["item_id", "item"])

    return map_chunks(benchmark, "text", work, "item_id long, item array<long>")


def _bit_map(seeds: DataFrame) -> np.ndarray:
    """A map with the bit of every seed set; its size follows the number of seeds up to ``MOST_BITS``."""
    count = seeds.count()
    bits = LEAST_BITS
    while bits < min(count * BITS_PER_SEED, MOST_BITS):
        bits *= 2
    places = F.explode(F.array(*[F.expr(f"{half} & {bits - 1}L") for half in (
        "hash", "shiftrightunsigned(hash, 32)")]))
    parts = (seeds.select(places.alias("place"))
             .select(F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas())  # at most bits / 64 rows
    table = np.zeros(bits // 64, np.uint64)
    table[parts["word"].to_numpy(np.int64)] = parts["bits"].to_numpy(np.int64).astype(np.uint64)
    return table


def _marked(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be of test seeds: both their bits are set."""
    out = np.ones(len(hashes), bool)
    for half in (hashes, hashes >> np.uint64(32)):
        place = half & np.uint64(len(table) * 64 - 1)
        out &= (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return out


def _stretches(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """Stretches of document words around marked seeds; those that touch are joined."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        words, limits = words_of(batch.column("text"), spaced=False)
        places, _, hashes = seeds_of(words, limits)
        hit = np.unique(places[_marked(table, hashes)])
        if not len(hit):
            return None
        row = row_numbers(limits)[hit]
        low = np.maximum(hit - _REACH, limits[row])
        high = np.minimum(hit + _REACH + 1, limits[row + 1])
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (low[1:] > high[:-1])))
        first = np.flatnonzero(new)
        low, high, row = low[first], np.maximum.reduceat(high, first), row[first]
        keys = run_hashes(words, low, high)
        inside = np.concatenate([words[a:b] for a, b in zip(low, high)])
        sizes = np.concatenate(([0], np.cumsum(high - low)))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(row)), pa.array(low - limits[row]), pa.array(keys.astype(np.int64)),
             pa.LargeListArray.from_arrays(pa.array(sizes), pa.array(inside.astype(np.int64))
                                           ).cast(pa.list_(pa.int64()))],
            names=["doc_id", "start", "stretch", "words"])

    return map_chunks(docs, "text", work, _STRETCH)


def _stretch_seeds(stretches: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            lists = batch.column("words")
            words = lists.flatten().to_numpy().astype(np.uint64)
            limits = np.asarray(lists.offsets, np.int64) - lists.offsets[0].as_py()
            places, _, hashes = seeds_of(words, limits)
            row = row_numbers(limits)[places]
            yield pa.RecordBatch.from_arrays(
                [batch.column("stretch").take(pa.array(row)), pa.array(places - limits[row]),
                 pa.array(hashes.astype(np.int64))], names=["stretch", "at", "hash"])

    return stretches.select("stretch", "words").mapInArrow(run, "stretch long, at long, hash long")


def overlap(words: np.ndarray, item: np.ndarray, shift: int, hits: np.ndarray) -> tuple[int, int, int] | None:
    """The words of the document's stretch that overlap an item on one diagonal: start, end, equal words.

    Item word i faces word i + shift.  ``hits`` are (place in the item, length) of the seeds on the diagonal.
    """
    low, high = max(0, -shift), min(len(item), len(words) - shift)
    span = min(SPAN, len(item))
    if high - low < span:
        return None
    same = item[low:high] == words[low + shift:high + shift]
    equal = np.concatenate(([0], np.cumsum(same)))
    count = equal[span:] - equal[:-span]
    begins = low + np.flatnonzero(count >= span - int(span * TOLERANCE))
    held = [b for b in begins.tolist() if any(b <= p and p + n <= b + span for p, n in hits)]
    if not held:
        return None
    a, b = min(held), max(held) + span
    return a + shift, b + shift, int(equal[b - low] - equal[a - low])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, doc_start, doc_end, n_words, n_equal) for each pair that overlaps, its longest overlap.

    Places are words of the document; ``n_words`` is the length of the overlap.
    """
    items = settle(benchmark.select(F.col("item_id").cast("long"), "text")
                   .where("item_id is not null and text is not null").distinct())
    picked = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    seeds = settle(_item_seeds(items))
    found = settle(_stretches(picked, _bit_map(seeds)))
    once = found.groupBy("stretch").agg(F.first("words").alias("words"))
    hits = (_stretch_seeds(once).join(seeds, "hash")
            .select("stretch", "item_id", (F.col("at") - F.col("place")).alias("shift"), "place").distinct())
    # A diagonal has at most one hit for each word of the item.
    diagonals = hits.groupBy("stretch", "item_id", "shift").agg(F.collect_set("place").alias("places"))
    aligned = diagonals.join(once, "stretch").join(_item_words(items), "item_id")

    def run(batches):
        for batch in batches:
            out = []
            columns = [batch.column(c) for c in ("stretch", "item_id", "shift", "places", "words", "item")]
            for stretch, item_id, shift, places, words, item in zip(*columns):
                item_words = item.values.to_numpy()
                facing = words.values.to_numpy()
                shift = shift.as_py()
                hits = []
                for place in places.as_py():
                    for mask in MASKS:  # the masks that hit there
                        if place + len(mask) <= len(item_words) and all(
                                kept == "0" or item_words[place + k] == facing[place + shift + k]
                                for k, kept in enumerate(mask) if place + shift + k < len(facing)):
                            hits.append((place, len(mask)))
                got = overlap(facing, item_words, shift, hits)
                if got:
                    out.append((stretch.as_py(), item_id.as_py(), *got))
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["stretch", "item_id", "low", "high", "n_equal"])

    overlaps = aligned.mapInArrow(run, "stretch long, item_id long, low long, high long, n_equal long")
    best = overlaps.groupBy("stretch", "item_id").agg(
        F.max_by(F.struct("low", "high", "n_equal"), F.struct(F.col("high") - F.col("low"), "n_equal",
                                                              -F.col("low"))).alias("o"))
    rows = found.select("doc_id", "start", "stretch").join(best, "stretch").select(
        "doc_id", "item_id", (F.col("start") + F.col("o.low")).alias("doc_start"),
        (F.col("start") + F.col("o.high")).alias("doc_end"), "o.n_equal")
    rows = rows.withColumn("n_words", F.col("doc_end") - F.col("doc_start"))
    longest = F.struct("n_words", "n_equal", -F.col("doc_start"))
    return rows.groupBy("doc_id", "item_id").agg(
        F.max_by(F.struct("doc_start", "doc_end", "n_words", "n_equal"), longest).alias("o")
    ).select("doc_id", "item_id", "o.*")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no item, rows of a null doc_id among them."""
    return docs.join(contaminated(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)
