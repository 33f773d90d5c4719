"""Near duplicates with an LSH forest.

A document's set are its distinct word shingles.  Equal sets are one node, named by the smallest doc_id.  Each
node has a MinHash signature, whose parts are its labels in several trees.  A tree is a sorted order of labels
(a range-partitioned sort); nodes that share a longer prefix stand closer.  Candidates are neighbours in an
order with a common prefix of ``LEAST_DEPTH`` hashes or more.  The depth adapts to the region: where more than
``REGION`` nodes share a prefix, only neighbours that share a longer one are taken, besides the next one.

Links are confirmed on the full sets.  As only components are wanted, candidates inside a component that is
already found are not compared: some rounds confirm each component's strongest candidate, the first one that of
each node, then all are compared that still lead from one component to another.  A region of more than ``REGION``
nodes that are then still in different components is searched whole, in blocks of at most ``BLOCK`` by ``BLOCK``
nodes: signatures tell which nodes of a block may have a link to another component, the texts of these follow, and
the block confirms all such pairs on their full sets.  Blocks give links only, at most one of a node and a component,
so what they give does not grow with the pairs they compare.  A pair that shares several regions is compared in the
first one only.

Texts are kept in a table bucketed by document, so the joins that bring them to their pairs shuffle the pairs only.

Words are lower-cased (A-Z) runs between the six ASCII white spaces.  With fewer words than a shingle has, the
whole sequence is the only shingle; without words, or with null text, the set is empty and linked with
nothing.  A null doc_id takes no part: its component is null and it is kept.  Rows of one doc_id are one
document for linking, whose sets are all its rows' sets; each row gives a row.  An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from fleetlens.llm.components import components
from fleetlens.llm.tables import chunks, map_chunks, release, settle, shared_dir
from fleetlens.llm.words import mix, run_hashes, words_of
from fleetlens.streaming.files import remove

TREES, DEPTH, LEAST_DEPTH = 16, 8, 3
#: Hashes of a label: those of its tree and of the next one, which tell nodes of a crowded region apart.
LABEL = 2 * DEPTH
REGION, ALWAYS = 8, 1
#: Rounds that confirm the strongest candidate of each component before the rest is compared.
ROUNDS = 2
#: Star rounds for the components between those; what stays apart is compared without need, no more.
STARS = 2
#: Nodes of a block's side; pairs of one node that a block confirms in one step.
BLOCK, PAIRS = 1024, 256
#: Signatures of linked sets agree in a share of places that is less than the similarity by at most this much.
SLACK = 0.15
SIGNED = "doc_id long, n_shingles long, key long, signature binary"
_FACTORS = np.random.default_rng(20260309).integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = np.random.default_rng(20260310).integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    words, limits = words_of(column, spaced=True)
    rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        rolled += words[k:k + len(rolled)] * np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64))
    rolled = mix(rolled)
    out = []
    for a, b in zip(limits[:-1].tolist(), limits[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            out.append(run_hashes(words[a:b], np.array([0]), np.array([b - a])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> bytes:
    """The smallest value under each hash function, as big-endian 32-bit numbers: labels sort as bytes."""
    least = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 4096):
        part = (shingles[None, k:k + 4096] ^ _SALTS[:, None]) * _FACTORS[:, None]
        np.minimum(least, part.min(1), out=least)
    return (least >> np.uint64(32)).astype(">u4").tobytes()


def _signed(docs: DataFrame, size: int) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text"), size)
        keys = [int(run_hashes(s, np.array([0]), np.array([len(s)]))[0].astype(np.int64)) for s in sets]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64()),
             pa.array([signature(s) if len(s) else None for s in sets], pa.binary())],
            names=["doc_id", "n_shingles", "key", "signature"])

    return map_chunks(docs.select(F.col("doc_id").cast("long"), "text"), "text", work, SIGNED)


def _by_document(texts: DataFrame) -> tuple[str, DataFrame]:
    """(node, text) as a table bucketed by node, with as many buckets as a join has partitions, and its name."""
    spark = texts.sparkSession
    count, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"texts_{uuid.uuid4().hex}"
    texts.repartition(count, "node").sortWithinPartitions("node").write.bucketBy(count, "node").sortBy("node").option(
        "path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    return name, spark.table(name)


# --- candidates from the sorted orders ---------------------------------------------------------------

_ORDERED = "tree int, label binary, node long"
_CANDIDATE = "a long, b long, depth int, tree int, label binary"


def _planted(nodes: DataFrame) -> DataFrame:
    """One row per node and tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signatures = [s + s for s in batch.column("signature").to_pylist()]
            for t in range(TREES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, t), pa.int32()),
                     pa.array([s[4 * DEPTH * t:4 * (DEPTH * t + LABEL)] for s in signatures], pa.binary()), batch.column("node")],
                    names=["tree", "label", "node"])

    return nodes.select("node", "signature").mapInArrow(run, _ORDERED)


def _labels(batch: pa.RecordBatch) -> np.ndarray:
    """Tree and hashes of each row as one matrix of numbers."""
    label = np.frombuffer(b"".join(batch.column("label").to_pylist()), ">u4").reshape(-1, LABEL)
    return np.hstack([batch.column("tree").to_numpy()[:, None], label.astype(np.int64)])


def _common(labels: np.ndarray, back: int) -> np.ndarray:
    """How many hashes each row shares, from the first one on, with the row ``back`` places before; -1: none."""
    out = np.full(len(labels), -1)
    if back < len(labels):
        same = np.cumprod(labels[back:] == labels[:-back], axis=1).sum(1)
        out[back:] = same - 1
    return out


def neighbours_in_order(nodes: np.ndarray, labels: np.ndarray, start: int) -> tuple[np.ndarray, ...]:
    """Candidates (smaller, larger, shared hashes) of rows ``start`` on with up to ``REGION`` rows before them."""
    crowd = _common(labels, REGION)
    found = []
    for back in range(1, REGION + 1):
        shared = _common(labels, back)
        wanted = (shared >= LEAST_DEPTH) & ((back <= ALWAYS) | (shared > crowd))
        wanted[:start] = False
        at = np.flatnonzero(wanted)
        found.append((nodes[at], nodes[at - back], shared[at]))
    mine, other, shared = (np.concatenate(x) for x in zip(*found))
    apart = mine != other
    mine, other, shared = mine[apart], other[apart], shared[apart]
    return np.minimum(mine, other), np.maximum(mine, other), shared


def _scan(batches: Iterator[pa.RecordBatch], with_borders: bool) -> Iterator[pa.RecordBatch]:
    """Candidates along a sorted partition; the rows next to its borders follow, for a scan of their own."""
    def border(rows: pa.Table) -> pa.RecordBatch:
        none = pa.nulls(rows.num_rows, pa.int64())
        return pa.RecordBatch.from_arrays(
            [rows.column("node").combine_chunks(), none, none.cast(pa.int32()), rows.column("tree").combine_chunks(),
             rows.column("label").combine_chunks()], names=["a", "b", "depth", "tree", "label"])

    tail: pa.Table | None = None
    seen = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        fresh = pa.Table.from_batches([batch])
        if with_borders and seen < REGION:
            yield border(fresh.slice(0, REGION - seen))
        rows = fresh if tail is None else pa.concat_tables([tail, fresh])
        whole = rows.combine_chunks().to_batches()[0]
        a, b, shared = neighbours_in_order(
            whole.column("node").to_numpy(), _labels(whole), 0 if tail is None else tail.num_rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b), pa.array(shared.astype(np.int32)), pa.nulls(len(a), pa.int32()),
             pa.nulls(len(a), pa.binary())], names=["a", "b", "depth", "tree", "label"])
        seen += batch.num_rows
        tail = rows.slice(max(0, rows.num_rows - REGION))
    if with_borders and tail is not None:
        yield border(tail)


def candidates(nodes: DataFrame) -> DataFrame:
    """(a, b, strength) with a < b: neighbours in any tree; strength is the sum of their common prefixes."""
    order = ["tree", "label", "node"]
    planted = _planted(nodes).repartitionByRange(*order).sortWithinPartitions(*order)
    found = settle(planted.mapInArrow(lambda batches: _scan(batches, True), _CANDIDATE))
    # 2 * REGION rows of each partition.
    edges = found.where("b is null").select("tree", "label", F.col("a").alias("node")).coalesce(1)
    across = edges.sortWithinPartitions(*order).mapInArrow(lambda batches: _scan(batches, False), _CANDIDATE)
    pairs = found.where("b is not null").unionByName(across)
    return pairs.groupBy("a", "b").agg(F.sum("depth").cast("long").alias("strength"))


# --- confirmation and components ---------------------------------------------------------------------

def _distinct_sets(texts: pa.ChunkedArray | pa.Array, size: int) -> list[np.ndarray]:
    """The shingle sets of texts, made once for each different text."""
    joined = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    coded = joined.cast(pa.large_string()).dictionary_encode()
    made = shingle_sets(coded.dictionary, size)
    return [made[k] for k in coded.indices.to_pylist()]


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on the full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in chunks(whole, "other")):
            passed = []
            for x, y in zip(_distinct_sets(batch.column("mine"), size), _distinct_sets(batch.column("other"), size)):
                small, large = sorted((x, y), key=len)
                if not len(small) or 100 * len(small) < percent * len(large):
                    passed.append(False)
                    continue
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                passed.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.filter(pa.array(passed)).select(["a", "b"])

    first = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("other")), "b")
    both = first.join(texts.select(F.col("node").alias("a"), F.col("text").alias("mine")), "a")
    return both.select("a", "b", "mine", "other").mapInArrow(run, "a long, b long")


def _between(pairs: DataFrame, found: DataFrame | None) -> DataFrame:
    """Pairs with the components of their ends (ca, cb), those inside one component left out."""
    if found is None:
        return pairs.withColumns({"ca": F.col("a"), "cb": F.col("b")})
    for end in ("a", "b"):
        named = found.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
        pairs = pairs.join(named, end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    return pairs.where("ca <> cb")


def _strongest(live: DataFrame) -> DataFrame:
    """For each component its strongest candidate, and only the strongest one between two components."""
    rank = F.struct("strength", (-F.col("a")).alias("x"), (-F.col("b")).alias("y"))
    pair = F.struct("a", "b")
    best = lambda df, *key: df.groupBy(*key).agg(F.max_by(pair, rank).alias("p"))
    both = best(live, "ca").select("p").unionByName(best(live, "cb").select("p"))
    return both.select("p.a", "p.b").distinct()


def region_keys(signatures: list[bytes]) -> np.ndarray:
    """Per node and tree the region of the nodes that share ``LEAST_DEPTH`` hashes."""
    heads = np.frombuffer(b"".join(signatures), ">u4").reshape(-1, TREES, DEPTH)[:, :, :LEAST_DEPTH].astype(np.uint64)
    keys = np.tile(np.arange(TREES, dtype=np.uint64), (len(heads), 1))
    for k in range(LEAST_DEPTH):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + heads[:, :, k])
    return keys


def _regions(nodes: DataFrame) -> DataFrame:
    """(region, node, c, s) of nodes (node, signature, c, s)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = region_keys(batch.column("signature").to_pylist()).ravel().astype(np.int64)
            again = pa.array(np.repeat(np.arange(batch.num_rows), TREES))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), *[batch.column(name).take(again) for name in ("node", "c", "s")]],
                names=["region", "node", "c", "s"])

    return nodes.select("node", "c", "s", "signature").mapInArrow(run, "region long, node long, c long, s long")


def _brief(nodes: DataFrame) -> DataFrame:
    """(node, n_shingles, brief, homes): one byte of each part of the signature, and the node's regions.

    Bytes agree where the parts do.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signatures = batch.column("signature").to_pylist()
            homes = region_keys(signatures)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("n_shingles"), pa.array([s[3::4] for s in signatures], pa.binary()),
                 pa.array([row.tobytes() for row in homes], pa.binary())], names=["node", "n_shingles", "brief", "homes"])

    return nodes.select("node", "n_shingles", "signature").mapInArrow(
        run, "node long, n_shingles long, brief binary, homes binary")


_MEMBER = ("region", "i", "j", "node", "c", "s", "n_shingles", "brief", "homes")


def near_pairs(left: pa.Table, right: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of ``left`` the rows of ``right`` that may be linked with it, the closest first.

    Only rows of other components, of which the node in the smaller one (size, then name) asks for the other; only
    where the block's region is the first one that both nodes share; and only where the signatures agree in at least
    the share that linked sets have, less ``SLACK``.
    """
    c, s, n = (left.column(name).to_numpy() for name in ("c", "s", "n_shingles"))
    their_c, their_s, their_n = (right.column(name).to_numpy() for name in ("c", "s", "n_shingles"))
    mine, theirs = (np.frombuffer(b"".join(side.column("brief").to_pylist()), np.uint8).reshape(-1, TREES * DEPTH)
                    for side in (left, right))
    home, their_home = (np.frombuffer(b"".join(side.column("homes").to_pylist()), np.uint64).reshape(-1, TREES)
                        for side in (left, right))
    region = left.column("region").to_numpy().astype(np.int64).view(np.uint64)[:1]
    least = int(np.ceil((percent / 100 - SLACK) * TREES * DEPTH))
    for k in range(len(c)):
        at = np.flatnonzero(
            (their_c != c[k]) & ((their_s > s[k]) | ((their_s == s[k]) & (their_c > c[k])))
            & (100 * np.minimum(their_n, n[k]) >= percent * np.maximum(their_n, n[k])))
        share = (theirs[at] == mine[k]).sum(1)
        at, share = at[share >= least], share[share >= least]
        first = (their_home[at] == home[k]).argmax(1)
        here = home[k][first] == region
        yield k, at[here][np.argsort(-share[here], kind="stable")]


def _crowded(nodes: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the blocks of regions of more than ``REGION`` nodes in different components.

    Nodes of a region's largest component do not ask.
    """
    sizes = found.groupBy("component").agg(F.count("*").alias("s"))
    named = found.join(sizes, "component").select("node", F.col("component").alias("c"), "s")
    placed = nodes.join(named, "node", "left").withColumns({"c": F.coalesce("c", "node"), "s": F.coalesce("s", F.lit(1))})
    rows = settle(_regions(placed))
    per_component = rows.groupBy("region", "s", "c").agg(F.count("*").alias("m"))
    shape = per_component.groupBy("region").agg(
        F.sum("m").alias("n"), F.count("*").alias("parts"), F.max(F.struct("s", "c", "m")).alias("top")
    ).where((F.col("n") > REGION) & (F.col("parts") > 1)).select(
        "region", "top.s", "top.c", F.ceil((F.col("n") - F.col("top.m")) / BLOCK).cast("int").alias("down"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("over"))
    shape = shape.withColumnsRenamed({"s": "top_s", "c": "top_c"})
    rows = rows.join(shape, "region").withColumn("asks", (F.col("s") != F.col("top_s")) | (F.col("c") != F.col("top_c")))
    rows = settle(rows.drop("top_s", "top_c").join(_brief(nodes), "node"))
    release(nodes.sparkSession)
    left = rows.where("asks").withColumns({
        "i": F.pmod(F.xxhash64("node"), F.col("down")).cast("int"), "j": F.explode(F.expr("sequence(0, over - 1)"))})
    right = rows.withColumns({
        "i": F.explode(F.expr("sequence(0, down - 1)")), "j": F.pmod(F.xxhash64("node"), F.col("over")).cast("int")})
    return left.select(*_MEMBER), right.select(*[F.col(name).alias(name) for name in _MEMBER])


def _crowd_links(nodes: DataFrame, found: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """(a, b): links between different components of crowded regions, at most one of a node and a component per block."""
    left, right = _crowded(nodes, found)
    keys = ["region", "i", "j"]
    kind = StructType([*left.schema.fields, StructField("asks", BooleanType())])

    def may_link(left: pa.Table, right: pa.Table) -> pa.Table:
        asking, asked = np.zeros(left.num_rows, bool), np.zeros(right.num_rows, bool)
        for k, at in near_pairs(left, right, percent):
            asking[k] = len(at) > 0
            asked[at] = True
        sides = [side.filter(pa.array(kept)) for side, kept in ((left, asking), (right, asked))]
        return pa.concat_tables([
            side.append_column("asks", pa.array(np.full(side.num_rows, first))) for side, first in zip(sides, (True, False))])

    def confirm(left: pa.Table, right: pa.Table) -> pa.Table:
        mine, theirs = (_distinct_sets(side.column("text"), size) for side in (left, right))
        node, their_node = left.column("node").to_numpy(), right.column("node").to_numpy()
        component, links = right.column("c").to_numpy(), []
        filled = np.array([len(one) > 0 for one in theirs], bool)  # a row of the same doc_id may have no words
        for k, at in near_pairs(left, right, percent):
            linked: set[int] = set()
            at = at[filled[at]] if len(mine[k]) else at[:0]
            while len(at):
                part, at = at[:PAIRS], at[PAIRS:]
                sizes = np.array([len(theirs[y]) for y in part])
                flat = np.concatenate([theirs[y] for y in part])
                there = mine[k][np.minimum(np.searchsorted(mine[k], flat), len(mine[k]) - 1)] == flat
                both = np.add.reduceat(there, np.cumsum(sizes) - sizes, dtype=np.int64)
                for y in part[100 * both >= percent * (sizes + len(mine[k]) - both)].tolist():
                    if component[y] not in linked:
                        linked.add(component[y])
                        links.append((node[k], their_node[y]))
                at = at[~np.isin(component[at], list(linked))]
        ends = np.array(links, np.int64).reshape(-1, 2)
        return pa.table([pa.array(ends.min(1)), pa.array(ends.max(1))], names=["a", "b"])

    members = settle(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(may_link, kind))
    release(nodes.sparkSession)
    told = members.join(texts, "node")
    sides = [told.where(side).select(*_MEMBER, "text") for side in ("asks", "not asks")]
    right = sides[1].select(*[F.col(name).alias(name) for name in sides[1].columns])
    return sides[0].groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(confirm, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document row."""
    signed = settle(_signed(docs, shingle))
    nodes = settle(signed.where("signature is not null and doc_id is not null").groupBy("key", "n_shingles")
             .agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")))
    pairs = settle(candidates(nodes))
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    name, texts = _by_document(docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(ends, "node", "left_semi"))
    release(docs.sparkSession)
    links = found = None
    for last in (*[False] * ROUNDS, True):
        live = settle(_between(pairs, found))
        chosen = live.select("a", "b") if last else _strongest(live)
        chosen = settle(chosen)
        passed = settle(confirmed(chosen, texts, percent, shingle))
        links = passed if links is None else links.unionByName(passed)
        found = components(links, None if last else STARS)
        if not last:  # what was compared and has no link is not compared again
            pairs = live.join(chosen, ["a", "b"], "left_anti").select("a", "b", "strength")
        release(docs.sparkSession)
    crowd = settle(_crowd_links(nodes, found, texts, percent, shingle))
    if not crowd.isEmpty():
        found = components(links.unionByName(crowd))
    docs.sparkSession.sql(f"DROP TABLE {name}")
    remove(docs.sparkSession, f"{shared_dir(docs.sparkSession)}/{name}")  # all that was read from it is checkpointed
    named = (nodes.select("key", "n_shingles", "node")
             .join(found, "node", "left").select("key", "n_shingles", F.coalesce("component", "node").alias("c")))
    own = signed.select("doc_id", "key", "n_shingles")
    linked = own.join(named, ["key", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("c"))
                       .otherwise(F.col("doc_id")))
    return linked.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group of near duplicates does."""
    dropped = near_duplicates(docs, shingle, percent).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)
