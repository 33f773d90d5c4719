"""Ranked lexical search of many items at once, with the work that items share done once.

Items are bags of terms, and an item's score of a document is the sum over its terms of an integer contribution.
Items share terms, so the plan of a batch of items is a graph: leaves are terms, a shared node is a set of terms
that at least two items have, an item is the sum of a few nodes.  Sets are mined by counting, round by round, the
pairs of nodes that items hold close to each other in order of frequency, and merging the commonest.  For each
block of documents every node's accumulator (one integer per document) is made once, however many items use it,
and dropped after its last use.

Documents are read once per batch of items into an index that holds, per block, the sizes of its documents and
the postings of the items' terms.  From the index come the corpus counts, and then the scores.  A task keeps the
best documents of each item over all its blocks; Spark merges those lists.  What a task holds is one block and one
plan: a block has at most ``BLOCK_DOCS`` documents, a plan the terms of its batch, at most ``BATCH_TERMS`` and
those of one more item.  More items make more batches.

Terms are runs of ASCII letters, digits and non-ASCII characters; only A-Z are lower-cased.  Terms are looked up
by hash and compared byte for byte.  Null texts have no terms.  Repeated documents count and are ranked each; a
null doc_id ranks before others of its score.  Rows of one item_id are one item, identical rows of it count once;
an item without terms has no result, nor has one whose terms no document holds.  Without documents or items the
result is empty.  Other columns take no part.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fleetlens.llm.tables import chunks, settle, ship, string_bytes
from fleetlens.llm.words import hash_spans, row_numbers
from fleetlens.plans import ordered_scan

TOP = 20
#: Saturation and length normalisation, in hundredths; the scale of a contribution.
K1, B, SCALE = 120, 25, 1_000_000
BATCH_TERMS, BLOCK_DOCS, NEAR = 1 << 16, 2048, 16
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_INDEX = ("n_docs long, n_terms long, ids array<long>, known array<boolean>, sizes array<long>, "
          "slots array<int>, places array<int>, counts array<int>, held array<int>, holders array<long>")
_FOUND = "item long, doc_id long, score long"
_NO_ID = np.iinfo(np.int64).min


# --- the plan of a batch of items ---------------------------------------------------------------------

@dataclass(frozen=True)
class Plan:
    """Leaves (vocabulary place and times it counts), shared nodes as pairs of earlier nodes, items as sums of nodes."""

    leaves: list[tuple[int, int]]
    pairs: list[tuple[int, int]]
    items: list[list[int]]

    def additions(self) -> int:
        """Additions of accumulators that the plan takes; without sharing there is one per term of an item."""
        return len(self.pairs) + sum(len(nodes) for nodes in self.items)


def share_terms(items: list[dict[int, int]]) -> Plan:
    """Mine the term sets that items (term -> times) share."""
    leaves = sorted({leaf for item in items for leaf in item.items()})
    number = {leaf: k for k, leaf in enumerate(leaves)}
    own: list[set[int]] = [{number[leaf] for leaf in item.items()} for item in items]
    holders: dict[int, set[int]] = defaultdict(set)
    for k, nodes in enumerate(own):
        for node in nodes:
            holders[node].add(k)
    pairs: list[tuple[int, int]] = []
    while True:
        seen: Counter[tuple[int, int]] = Counter()
        for nodes in own:
            line = sorted((x for x in nodes if len(holders[x]) > 1), key=lambda x: (-len(holders[x]), x))
            for k, x in enumerate(line):
                for y in line[k + 1:k + 1 + NEAR]:
                    seen[x, y] += 1
        found, touched = False, set()
        for (x, y), times in sorted(seen.items(), key=lambda pair: (-pair[1], pair[0])):
            if times < 2:
                break
            both = [k for k in holders[x] & holders[y] if (k, x) not in touched and (k, y) not in touched]
            if len(both) < 2:
                continue
            node, found = len(leaves) + len(pairs), True
            pairs.append((x, y))
            for k in both:
                own[k] -= {x, y}
                own[k].add(node)
                holders[x].discard(k)
                holders[y].discard(k)
                holders[node].add(k)
                touched |= {(k, x), (k, y), (k, node)}
        if not found:
            return Plan(leaves, pairs, [sorted(nodes) for nodes in own])


class Accumulators:
    """The nodes' sums over one block of documents: made on first use, dropped after the last."""

    def __init__(self, plan: Plan, slots: np.ndarray, places: np.ndarray, parts: np.ndarray, n_docs: int) -> None:
        self.plan, self.places, self.parts, self.n_docs = plan, places, parts, n_docs
        self.limits = np.searchsorted(slots, np.arange(max((s for s, _ in plan.leaves), default=-1) + 2))
        self.left = Counter(node for pair in plan.pairs for node in pair)
        self.left.update(node for nodes in plan.items for node in nodes)
        self.made: dict[int, np.ndarray] = {}

    def _make(self, node: int) -> np.ndarray:
        if node >= len(self.plan.leaves):
            x, y = self.plan.pairs[node - len(self.plan.leaves)]
            return self.use(x) + self.use(y)
        slot, times = self.plan.leaves[node]
        out = np.zeros(self.n_docs, np.int64)
        span = slice(self.limits[slot], self.limits[slot + 1])
        out[self.places[span]] = self.parts[span] * times
        return out

    def use(self, node: int) -> np.ndarray:
        if node not in self.made:
            self.made[node] = self._make(node)
        self.left[node] -= 1
        return self.made[node] if self.left[node] else self.made.pop(node)

    def item(self, k: int) -> np.ndarray:
        total = np.zeros(self.n_docs, np.int64)
        for node in self.plan.items[k]:
            total += self.use(node)
        return total


# --- terms of texts -----------------------------------------------------------------------------------

def term_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all rows, starts and ends of the terms in them, and n + 1 row limits among terms."""
    data, limits = string_bytes(column)
    none = np.zeros(0, np.int64)
    if not len(data):
        return data, none, none, np.zeros(len(limits), np.int64)
    lower = data.copy()
    lower[(data >= 65) & (data <= 90)] += 32
    inside = ((lower >= 97) & (lower <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)
    edge = np.zeros(len(data) + 1, bool)
    edge[limits] = True
    starts = np.flatnonzero(inside & (~np.concatenate(([False], inside[:-1])) | edge[:-1]))
    ends = np.flatnonzero(inside & (~np.concatenate((inside[1:], [False])) | edge[1:])) + 1
    return lower, starts, ends, np.searchsorted(starts, limits)


class Vocabulary:
    """The terms of a batch of items; a term's place is its number in order of hash."""

    def __init__(self, terms: list[str]) -> None:
        lower, starts, ends, _ = term_spans(pa.array(terms, pa.string()))
        hashes = hash_spans(lower, starts, ends)
        order = np.argsort(hashes, kind="stable")
        self.terms = [terms[k] for k in order]
        self.hashes, self.bytes = hashes[order], lower
        self.starts, self.sizes = starts[order], (ends - starts)[order]
        # entries of one hash, of which there is all but always one
        self.width = max(np.unique(hashes, return_counts=True)[1].tolist(), default=0)

    def find(self, lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Place of each term, -1 where it is not in the vocabulary."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.hashes):
            return out
        hashes = hash_spans(lower, starts, ends)
        first = np.searchsorted(self.hashes, hashes)
        for step in range(self.width):
            place = np.minimum(first + step, len(self.hashes) - 1)
            like = np.flatnonzero((self.hashes[place] == hashes) & (self.sizes[place] == ends - starts) & (out < 0))
            if not len(like):
                continue
            sizes = (ends - starts)[like]
            inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            same = lower[np.repeat(starts[like], sizes) + inner] == self.bytes[
                np.repeat(self.starts[place[like]], sizes) + inner]
            right = np.logical_and.reduceat(same, np.cumsum(sizes) - sizes)
            out[like[right]] = place[like[right]]
        return out


def index_block(ids: pa.Array, texts: pa.Array, vocabulary: Vocabulary) -> dict[str, object]:
    """One block of the index: documents with a term, and the postings of vocabulary terms by (term, document)."""
    lower, starts, ends, limits = term_spans(texts)
    sizes = np.diff(limits)
    some = np.flatnonzero(sizes)
    found = vocabulary.find(lower, starts, ends)
    place = np.cumsum(sizes > 0) - 1  # of a row among the documents with a term
    hit = found >= 0
    n_docs = len(some)
    key, counts = np.unique(found[hit] * max(n_docs, 1) + place[row_numbers(limits)[hit]], return_counts=True)
    slots, places = key // max(n_docs, 1), key % max(n_docs, 1)
    held, holders = np.unique(slots, return_counts=True)
    known = np.asarray(ids.is_valid())[some]
    numbers = ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)[some]
    return {"n_docs": n_docs, "n_terms": int(sizes.sum()), "ids": numbers, "known": known, "sizes": sizes[some],
            "slots": slots.astype(np.int32), "places": places.astype(np.int32), "counts": counts.astype(np.int32),
            "held": held.astype(np.int32), "holders": holders}


def _index(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                for start in range(0, part.num_rows, BLOCK_DOCS):
                    block = part.slice(start, BLOCK_DOCS)
                    row = index_block(block.column("doc_id"), block.column("text"), vocabulary)
                    yield pa.RecordBatch.from_pydict({name: [value] for name, value in row.items()}, pa.schema([
                        ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.list_(pa.int64())),
                        ("known", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())),
                        ("slots", pa.list_(pa.int32())), ("places", pa.list_(pa.int32())),
                        ("counts", pa.list_(pa.int32())), ("held", pa.list_(pa.int32())),
                        ("holders", pa.list_(pa.int64()))]))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, _INDEX)


# --- scores -------------------------------------------------------------------------------------------

def contributions(weights: np.ndarray, slots: np.ndarray, counts: np.ndarray, sizes: np.ndarray, n_docs: int,
                  n_terms: int) -> np.ndarray:
    """The integer contribution of each posting, given the size of its document."""
    norm = 100 - B + (B * sizes * n_docs) // n_terms
    tf = counts.astype(np.int64)
    return weights[slots] * ((1000 * SCALE * tf) // (1000 * tf + K1 // 10 * norm))


def best(scores: np.ndarray, ids: np.ndarray, known: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` highest scores above 0, ties to the smaller id, a null id first."""
    if len(scores) > top:
        least = max(int(np.partition(scores, len(scores) - top)[len(scores) - top]), 1)
    else:
        least = 1
    some = np.flatnonzero(scores >= least)
    return some[np.lexsort((ids[some], known[some], -scores[some]))][:top]


def _search(index: DataFrame, plan: Plan, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    def column(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
        return batch.column(name)[row].values.to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        kept = [nothing] * len(plan.items)
        for batch in batches:
            for row in range(batch.num_rows):
                ids, known, sizes = (column(batch, name, row) for name in ("ids", "known", "sizes"))
                slots, places, counts = (column(batch, name, row) for name in ("slots", "places", "counts"))
                if not len(slots):
                    continue
                parts = contributions(weights, slots, counts, sizes[places], n_docs, n_terms)
                sums = Accumulators(plan, slots, places, parts, len(ids))
                for k in range(len(plan.items)):
                    scores = sums.item(k)
                    here = best(scores, ids, known, top)
                    if len(here):
                        joined = [np.concatenate((old, new[here])) for old, new in zip(kept[k], (scores, ids, known))]
                        order = best(*joined, top)
                        kept[k] = tuple(part[order] for part in joined)
        sizes = [len(scores) for scores, _, _ in kept]
        if sum(sizes):
            scores, ids, known = (np.concatenate([entry[k] for entry in kept]) for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(kept)), sizes), pa.int64()), pa.array(ids, pa.int64(), mask=~known),
                 pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])

    return index.select("ids", "known", "sizes", "slots", "places", "counts").mapInArrow(run, _FOUND)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times, batch): the bags of terms of the items, in batches of about ``BATCH_TERMS`` terms."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    terms = F.regexp_extract_all(F.translate("text", _CAPITALS, _SMALL), F.lit(_TERM), F.lit(0))
    bags = settle(rows.select("item_id", F.explode(terms).alias("term")).groupBy("item_id", "term").agg(
        F.count(F.lit(1)).alias("times")))
    sizes = bags.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    upto, before = (Window.unboundedPreceding, Window.currentRow), (Window.unboundedPreceding, -1)
    summed = ordered_scan(
        sizes, [], ["item_id"],
        local=lambda w: [{"_upto": F.sum("n").over(w.rowsBetween(*upto))}],
        totals={"_all": F.sum("n")},
        inherit=lambda w: [{"_before": F.sum("_all").over(w.rowsBetween(*before))}], inherited="_before long")
    batch = F.floor((F.col("_upto") + F.coalesce("_before", F.lit(0)) - F.col("n")) / BATCH_TERMS).cast("int")
    placed = summed.select(F.col("item_id").alias("_item"), batch.alias("batch"))
    return bags.join(placed, F.col("item_id").eqNullSafe(F.col("_item"))).drop("_item")


def _batch(docs: DataFrame, bags: DataFrame, top: int) -> DataFrame:
    """The best documents of the items of one batch."""
    spark = docs.sparkSession
    rows = bags.collect()  # bounded: one batch
    vocabulary = Vocabulary(sorted({row["term"] for row in rows}))
    slot = {term: k for k, term in enumerate(vocabulary.terms)}
    by_item: dict[int | None, dict[int, int]] = defaultdict(dict)
    for row in rows:
        by_item[row["item_id"]][slot[row["term"]]] = row["times"]
    names = sorted(by_item, key=lambda name: (name is not None, name))
    plan = share_terms([by_item[name] for name in names])
    index = settle(_index(docs, vocabulary))
    sums = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).head()
    n_docs, n_terms = sums["docs"] or 0, sums["terms"] or 0
    held = index.select(F.explode(F.arrays_zip("held", "holders")).alias("h")).groupBy("h.held").agg(
        F.sum("h.holders").alias("df")).collect()  # bounded: a row per term of the batch
    weights = np.zeros(len(vocabulary.terms), np.int64)
    for row in held:
        weights[row["held"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row["df"] + 1)))
    labels = spark.createDataFrame(list(enumerate(names)), "item long, item_id long")
    return _search(index, plan, weights, n_docs, max(n_terms, 1), top).join(labels, "item").select(
        "item_id", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents (doc_id, text) of every item (item_id, text).

    Corpus counts are of all documents, and every document is scored for every item.
    """
    spark = docs.sparkSession
    ship(spark)
    bags = settle(item_terms(items))
    last = bags.agg(F.max("batch")).head()[0]
    found = [_batch(docs, bags.where(F.col("batch") == k), top) for k in range(0 if last is None else last + 1)]
    whole = reduce(DataFrame.unionByName, found, spark.createDataFrame([], "item_id long, doc_id long, score long"))
    place = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return whole.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top).select(
        "item_id", "rank", "doc_id", "score")
