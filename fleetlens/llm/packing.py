"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm on islands.

A document is its token ids and one closing id 0.  Longer documents are cut into pieces of ``capacity``
tokens, the first one taking the remainder.  Full pieces are sequences of their own.  The others go into
blocks of about ``block_size`` by a hash of their key, so no group grows with the input.  Each block is
evolved on several islands, each a Spark task of its own: individuals are groupings of pieces into bins;
crossover injects whole well-filled bins of another parent, drops the bins that share a piece with them, and
best-fits the displaced pieces.  Between epochs the islands of a block exchange their elites through a
shuffle.  Bins that stay poorly filled are packed once more across blocks.

Null text is empty and gives the closing id alone.  Repeated rows are pieces of their own.  An empty table
gives no rows.  Null doc_ids pass through.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.tables import map_chunks, settle

CAPACITY = 2048
BLOCK_SIZE = 4096
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 5
#: Bins with more free room than this part of the capacity are packed again across blocks.
POOR = 1 / 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: The vocabulary's split pattern, and the same without its look-ahead, which only matters between two white
#: spaces and makes matching slow.  Both are used for Latin script only, where all libraries agree on letters.
_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+", r"|\s+(?!\S)", r"|\s+")
_UNUSUAL = re.compile(r"[^\t-\r -~\xa0-ɏ]")
_TWO_SPACES = re.compile(r"\s\s")


@lru_cache(maxsize=1)
def _byte_letters() -> dict[str, int]:
    """Which byte a letter of a vocabulary entry means: printable Latin-1 itself, the others moved up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(moved)}}


def _vocabulary_bytes(word: str) -> bytes:
    values = _byte_letters()
    return bytes(values[c] for c in word)


@lru_cache(maxsize=2)
def _encoders(path: str) -> tuple:
    """The tokenizer, and its merges with the full and with the simple split pattern.

    Ids of this kind of vocabulary are in the order of its merges, so ranks give the same ids, much faster.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ranks = {_vocabulary_bytes(word): k for word, k in tokenizer.get_vocab(False).items()
             if not word.startswith("<|")}
    full, simple = (tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
                    for name, pattern in (("full", "".join(_SPLIT)), ("simple", _SPLIT[0] + _SPLIT[2])))
    return tokenizer, full, simple


def encode(text: str, path: str) -> bytes:
    """Token ids of a text as little-endian unsigned 32-bit numbers, as the tokenizer gives them by default.

    So a special token that a text spells out is one id; only the tokenizer itself sees such texts.
    """
    tokenizer, full, simple = _encoders(path)
    if "<|" in text or _UNUSUAL.search(text):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
    else:
        ids = (full if _TWO_SPACES.search(text) else simple).encode_ordinary(text)
    return np.array(ids, "<u4").tobytes()


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int]]:
    """Start, length and checksum of each piece; the first one takes what does not fill a piece."""
    count = len(ids) // 4
    first = count % capacity or min(count, capacity)
    limits = [0, *range(first, count + 1, capacity)]
    return [(a, b - a, zlib.crc32(ids[4 * a:4 * b])) for a, b in zip(limits, limits[1:])]


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each document row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids = encode(text or "", path) + b"\0\0\0\0"
            rows += [(doc_id, k, *piece) for k, piece in enumerate(cut(ids, capacity))]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
            names=[part.split()[0] for part in PIECES.split(", ")])

    return map_chunks(docs.selectExpr("cast(doc_id as long) doc_id", "text"), "text", work, PIECES)


# --- one block on one island -------------------------------------------------------------------------

Bins = list[list[int]]


def best_fit(order, sizes: list[int], capacity: int, bins: Bins, room: list[int]) -> None:
    """Put each item into the open bin that it leaves least room in, else into a new one.  In place."""
    free = sorted((r, k) for k, r in enumerate(room) if r > 0)
    for item in order:
        size = sizes[item]
        at = bisect.bisect_left(free, (size, -1))
        if at < len(free):
            left, k = free.pop(at)
            bins[k].append(item)
        else:
            left, k = capacity, len(bins)
            bins.append([item])
            room.append(capacity)
        left -= size
        room[k] = left
        if left:
            bisect.insort(free, (left, k))


def fitness(bins: Bins, sizes: list[int], capacity: int) -> float:
    """Mean square of the bins' filling: fewer and fuller bins are better."""
    return sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / len(bins) if bins else 1.0


def cross(mother: Bins, father: Bins, sizes: list[int], capacity: int, rng: np.random.Generator) -> Bins:
    """The mother's bins with some of the father's best filled ones injected whole."""
    filled = sorted(range(len(father)), key=lambda k: -sum(sizes[i] for i in father[k]))
    good = filled[:max(1, len(filled) // 2)]
    take = rng.choice(len(good), max(1, len(good) // 4), replace=False)
    injected = [list(father[good[k]]) for k in take]
    placed = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in mother:
        if placed.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced += [i for i in b if i not in placed]
    return _refit(injected + kept, displaced, sizes, capacity)


def _refit(bins: Bins, loose: list[int], sizes: list[int], capacity: int) -> Bins:
    room = [capacity - sum(sizes[i] for i in b) for b in bins]
    best_fit(sorted(loose, key=lambda i: -sizes[i]), sizes, capacity, bins, room)
    return bins


def mutate(bins: Bins, sizes: list[int], capacity: int, rng: np.random.Generator) -> Bins:
    """Dissolve the emptiest bins and a few others, and best-fit their items again."""
    order = sorted(range(len(bins)), key=lambda k: sum(sizes[i] for i in bins[k]))
    gone = set(order[:1 + len(bins) // 50]) | set(rng.choice(len(bins), 1 + len(bins) // 50).tolist())
    loose = [i for k in gone for i in bins[k]]
    return _refit([list(b) for k, b in enumerate(bins) if k not in gone], loose, sizes, capacity)


def decode(code: np.ndarray) -> Bins:
    """Bins of an individual given as the bin number of each item."""
    order = np.argsort(code, kind="stable")
    return [part.tolist() for part in np.split(order, np.flatnonzero(np.diff(code[order])) + 1)] if len(code) else []


def encode_bins(bins: Bins, count: int) -> np.ndarray:
    code = np.zeros(count, np.int32)
    for k, b in enumerate(bins):
        code[b] = k
    return code


def evolve(sizes: list[int], capacity: int, guests: list[np.ndarray], seed: int,
           population: int = POPULATION, generations: int = GENERATIONS) -> Bins:
    """The best grouping that some generations give, starting from best-fit orders and the guests."""
    rng = np.random.default_rng(seed)
    least = -(-sum(sizes) // capacity)
    down = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    people: list[Bins] = [decode(g) for g in guests]
    while len(people) < population:
        order = down
        if people:  # nearly decreasing
            noisy = np.array(sizes) * rng.uniform(0.8, 1.2, len(sizes))
            order = np.argsort(-noisy, kind="stable").tolist()
        bins: Bins = []
        best_fit(order, sizes, capacity, bins, [])
        people.append(bins)
        if len(bins) == least:
            return bins
    score = lambda b: (-len(b), fitness(b, sizes, capacity))
    people.sort(key=score, reverse=True)
    for _ in range(generations):
        if len(people[0]) <= least:
            break
        children = []
        for _ in range(population // 2):
            a, b = rng.choice(len(people), 2, replace=len(people) < 2)
            child = cross(people[a], people[b], sizes, capacity, rng)
            children.append(mutate(child, sizes, capacity, rng))
        people = sorted(people + children, key=score, reverse=True)[:population]
    return people[0]


# --- blocks and islands on Spark ---------------------------------------------------------------------

_EVOLVED = "block long, island int, n_bins long, fit double, keys array<long>, code array<int>"


def _one_epoch(items: DataFrame, guests: DataFrame | None, capacity: int, epoch: int) -> DataFrame:
    """Evolve each (block, island); ``guests`` are elites that arrive there, as rows of ``_EVOLVED``."""

    def run(left: pa.Table, right: pa.Table | None = None) -> pa.Table:
        block, island = left.column("block")[0].as_py(), left.column("island")[0].as_py()
        left = left.sort_by("key")
        sizes = left.column("length").to_pylist()
        arriving = []
        if right is not None:
            for code in right.column("code"):
                arriving.append(np.asarray(code.values, np.int32))
        seed = (block * 1009 + island * 31 + epoch) % (1 << 32)
        bins = evolve(sizes, capacity, arriving, seed)
        code = encode_bins(bins, len(sizes))
        return pa.table({
            "block": pa.array([block], pa.int64()), "island": pa.array([island], pa.int32()),
            "n_bins": pa.array([len(bins)], pa.int64()),
            "fit": pa.array([fitness(bins, sizes, capacity)], pa.float64()),
            "keys": pa.array([left.column("key").to_pylist()], pa.list_(pa.int64())),
            "code": pa.array([code], pa.list_(pa.int32()))})

    grouped = items.groupBy("block", "island")
    if guests is None:
        return grouped.applyInArrow(lambda t: run(t), _EVOLVED)
    return grouped.cogroup(guests.groupBy("block", "island")).applyInArrow(
        lambda a, b: run(a, b), _EVOLVED)


def pack_items(items: DataFrame, capacity: int = CAPACITY, block_size: int = BLOCK_SIZE,
               islands: int = ISLANDS, epochs: int = EPOCHS, level: int = 0) -> DataFrame:
    """Pack (key, length) rows with distinct keys: (key, sequence_id, offset)."""
    count = items.count()
    blocks = max(1, -(-count // block_size))
    dealt = items.select(
        "key", "length", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(blocks)).alias("block"),
        F.explode(F.expr(f"sequence(0, {islands - 1})")).alias("island"))
    elite = _one_epoch(dealt, None, capacity, 0)
    for epoch in range(1, epochs):
        # Each island gets its own elite back and that of its neighbour.
        moved = elite.withColumn("island", F.explode(F.array(
            "island", ((F.col("island") + 1) % islands).cast("int"))))
        elite = _one_epoch(dealt, moved.dropDuplicates(["block", "island", "fit"]), capacity, epoch)
    best = elite.groupBy("block").agg(
        F.max_by(F.struct("keys", "code"), F.struct(-F.col("n_bins"), "fit", -F.col("island"))).alias("won"))
    placed = (best.select("block", F.explode(F.arrays_zip("won.keys", "won.code")).alias("x"))
              .select(F.col("x.keys").alias("key"),
                      (F.lit(level << 60) + F.shiftleft(F.col("block").cast("long"), 32) + F.col("x.code")).alias("sequence_id")))
    return placed.join(items.select("key", "length"), "key")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, block_size: int = BLOCK_SIZE) -> DataFrame:
    """All pieces of ``docs`` with their place: (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    # The key made here must not change on a later reading, so it is settled with the pieces.
    pieces = settle(pieces_of(docs, path, capacity).withColumn("key", F.monotonically_increasing_id()))
    short = pieces.where(F.col("length") < capacity).select("key", "length")
    first = settle(pack_items(short, capacity, block_size))
    fill = first.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    poor = fill.where(F.col("fill") < capacity * (1 - POOR)).select("sequence_id")
    again = first.join(poor, "sequence_id", "left_semi").select("key", "length")
    second = pack_items(settle(again), capacity, block_size, level=1)
    bins = first.join(poor, "sequence_id", "left_anti").select("key", "sequence_id", "length").unionByName(
        second.select("key", "sequence_id", "length"))
    # A bin holds at most ``capacity`` pieces, as none is empty.
    before = "sum(length) over (partition by sequence_id order by key rows between unbounded preceding and 1 preceding)"
    placed = bins.selectExpr("key", "sequence_id", f"coalesce({before}, 0) as offset")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = pieces.where(F.col("length") >= capacity).withColumns(
        {"sequence_id": -F.col("key") - 1, "offset": F.lit(0).cast("long")})
    return pieces.join(placed, "key").select(names).unionByName(full.select(names))
