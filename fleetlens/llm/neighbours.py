"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length one, where the order by distance is the order by cosine.  Each of several tables
cuts some Gaussian projections into cells of fixed width; a vector lies in one bucket per table.  A query
visits buckets of each table in the order of the probability that a neighbour at distance ``radius`` lies
there (for projection values f of the query, that value of the neighbour is normal around f), until the visited
ones hold ``success`` of it.  Candidates of all visited buckets of all tables are ranked by their exact cosine.

Equal vectors are indexed once, with their smallest ids; no more of them can be among a query's nearest.
Buckets are split by a hash into parts of bounded size, on both sides, so a crowded bucket is many groups.
Should the tables find fewer candidates than are asked for, the query is compared with every vector, again in
parts of bounded size.

Null and zero vectors, and those with null or non-finite components, take no part, nor do null ids and vectors
whose size is not that of most.  Repeated rows of one id and vector count once; one id with several vectors
stands for each of them.  An empty table gives no rows.
"""

from __future__ import annotations

from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fleetlens.llm.tables import settle, ship

TABLES, HASHES, WIDTH = 6, 5, 1.5
RADIUS, SUCCESS = 1.03, 0.48
PART = 4096
SEED = 20260207
_FOUND = "query_id long, vec_id long, score double"
_phi = np.vectorize(erf)


def planes(size: int, tables: int, hashes: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Projections (tables x size x hashes) and shifts (tables x hashes), the same in every task."""
    rng = np.random.default_rng(SEED)
    return rng.normal(size=(tables, size, hashes)), rng.uniform(0, width, (tables, hashes))


def bucket_codes(cells: np.ndarray) -> np.ndarray:
    """One number per row of cell numbers (each within -512..511)."""
    code = np.zeros(cells.shape[:-1], np.int64)
    for k in range(cells.shape[-1]):
        code = (code << 10) | (np.clip(cells[..., k], -512, 511) + 512)
    return code


def probe_order(values: np.ndarray, width: float, radius: float, success: float) -> np.ndarray:
    """Cells of one query in one table (probes x hashes), the likeliest first, until they hold ``success``."""
    reach = max(1, int(np.ceil(3.5 * radius / width)))
    home = np.floor(values / width).astype(np.int64)
    steps = np.arange(-reach, reach + 1)
    edges = (home[:, None] + np.arange(-reach, reach + 2)) * width
    share = np.diff(0.5 * (1 + _phi((edges - values[:, None]) / (radius * sqrt(2)))), axis=1)
    chance, chosen = np.ones(1), np.zeros((1, 0), np.int64)
    for k in range(len(values)):  # buckets that cannot matter are left out on the way
        chance = (chance[:, None] * share[k]).ravel()
        chosen = np.hstack([np.repeat(chosen, len(steps), 0),
                            np.tile(steps, len(chosen))[:, None] + home[k]])
        order = np.argsort(-chance, kind="stable")
        keep = order[:np.searchsorted(np.cumsum(chance[order]), 0.999 * chance.sum()) + 1]
        chance, chosen = chance[keep], chosen[keep]
    order = np.argsort(-chance, kind="stable")
    return chosen[order[:np.searchsorted(np.cumsum(chance[order]), success) + 1]]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, size)


def _units(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def clean(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec): the vectors that take part."""
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
            .where(sound & F.exists("vec", lambda x: x != 0)))


def _smallest_ids(count: int):
    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch]).to_pandas()
            table["vec"] = [v.tobytes() for v in table["vec"]]
            table = table.drop_duplicates().sort_values("vec_id").groupby("vec", sort=False).head(count)
            yield pa.RecordBatch.from_arrays([
                pa.array(table["vec_id"], pa.int64()),
                pa.array([np.frombuffer(v) for v in table["vec"]], pa.list_(pa.float64()))], names=["vec_id", "vec"])
    return run


def distinct_vectors(sound: DataFrame, count: int) -> DataFrame:
    """(rep, ids, vec): each different vector with its ``count`` smallest ids, ``rep`` being the smallest."""
    # Every Arrow batch first keeps the ids that can matter, so a crowd of copies meets as a few rows per batch.
    fewer = sound.mapInArrow(_smallest_ids(count), "vec_id long, vec array<double>")
    ids = F.slice(F.array_sort(F.collect_set("vec_id")), 1, count)
    return fewer.groupBy("vec").agg(ids.alias("ids")).select(F.col("ids")[0].alias("rep"), "ids", "vec")


def _compare(left: pa.Table, right: pa.Table, size: int, count: int) -> pa.Table:
    """Exact cosines of queries (left) with vectors (right): the best ``count`` + 1 ids of each query."""
    queries, vectors = _matrix(left.column("vec").combine_chunks(), size), _matrix(
        right.column("vec").combine_chunks(), size)
    ids = right.column("ids").to_pylist()
    reps = right.column("rep").to_numpy()
    rough = _units(queries) @ _units(vectors).T
    keep = min(count + 1, rough.shape[1])
    out: tuple[list, list, list] = ([], [], [])
    lengths = np.sqrt((vectors * vectors).sum(1))
    for k, query_id in enumerate(left.column("query_id").to_pylist()):
        # All within rounding of the last place that can matter are measured exactly.
        last = np.partition(rough[k], -keep)[-keep]
        near = np.flatnonzero(rough[k] >= last - 1e-9)
        exact = (vectors[near] * queries[k]).sum(1) / (lengths[near] * np.sqrt((queries[k] ** 2).sum()))
        order = np.lexsort((reps[near], -exact))
        found = sorted((-exact[at], vec_id) for at in order for vec_id in ids[near[at]] if vec_id != query_id)
        for negative, vec_id in found[:count]:
            out[0].append(query_id)
            out[1].append(vec_id)
            out[2].append(-negative)
    return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                    names=["query_id", "vec_id", "score"])


def _compare_buckets(left: pa.Table, right: pa.Table, size: int, count: int) -> pa.Table:
    """:func:`_compare` for each bucket of a group."""
    left, right = left.sort_by("bucket").combine_chunks(), right.sort_by("bucket").combine_chunks()
    mine, theirs = left.column("bucket").to_numpy(), right.column("bucket").to_numpy()
    done = [pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())],
                     names=["query_id", "vec_id", "score"])]
    for bucket in np.intersect1d(mine, theirs):
        (a, b), (c, d) = (np.searchsorted(x, [bucket, bucket + 1]) for x in (mine, theirs))
        done.append(_compare(left.slice(a, b - a), right.slice(c, d - c), size, count))
    return pa.concat_tables(done)


def _by_parts(queries: DataFrame, index: DataFrame, rows: int, size: int, count: int) -> DataFrame:
    """Compare queries and vectors with equal (table, bucket).

    Groups have about ``PART`` rows on either side: a large bucket is cut into parts, small ones share a group.
    ``rows`` is the number of vectors in a table.
    """
    key = ["table", "bucket"]
    shared = max(1, -(-2 * rows // PART))
    sizes = settle(
        index.groupBy(*key).agg(F.count("*").alias("n_index"))
        .join(queries.groupBy(*key).agg(F.count("*").alias("n_query")), key)
        .select(*key, F.ceil(F.col("n_index") / PART).cast("int").alias("over"),
                F.ceil(F.col("n_query") / PART).cast("int").alias("down"))
        .withColumn("small", (F.col("over") == 1) & (F.col("down") == 1))
        .withColumn("place", F.when(F.col("small"), F.pmod(F.xxhash64("bucket"), F.lit(shared)))
                    .otherwise(F.col("bucket"))))
    groups = ["table", "small", "place", "x", "y"]
    split = index.join(sizes, key).withColumns(
        {"x": F.pmod(F.xxhash64("rep", F.lit(1)), F.col("over")).cast("int"),
         "y": F.explode(F.expr("sequence(0, down - 1)"))}).select(*groups, "bucket", "rep", "ids", "vec")
    asked = queries.join(sizes, key).withColumns(
        {"x": F.explode(F.expr("sequence(0, over - 1)")),
         "y": F.pmod(F.xxhash64("query_id", F.lit(2)), F.col("down")).cast("int")}
    ).select(*groups, "bucket", "query_id", "vec")
    return asked.groupBy(*groups).cogroup(split.groupBy(*groups)).applyInArrow(
        lambda left, right: _compare_buckets(left, right, size, count), _FOUND)


def _best(found: DataFrame, count: int) -> DataFrame:
    """The ``count`` best different ids per query, with ranks; a few rows per visited group come in."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
            .select("query_id", "rank", "vec_id", "score"))


def nearest(vectors: DataFrame, queries: DataFrame, count: int = 5, tables: int = TABLES, hashes: int = HASHES,
            width: float = WIDTH, radius: float = RADIUS, success: float = SUCCESS) -> DataFrame:
    """For each row of ``queries`` the ``count`` nearest other ids: (query_id, rank, vec_id, score)."""
    ship(vectors.sparkSession)
    sound = clean(vectors)
    sizes = sound.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").head()
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = sizes["size"]
    sound = sound.where(F.size("vec") == size)
    asked = clean(queries).where(F.size("vec") == size).withColumnRenamed("vec_id", "query_id").distinct()
    # The ids settled here are read three times below.
    distinct = settle(distinct_vectors(sound, count + 1))
    rows = distinct.count()
    axes, shifts = planes(size, tables, hashes, width)

    def index(batches):
        for batch in batches:
            values = np.einsum("ns,tsh->tnh", _units(_matrix(batch.column("vec"), size)), axes) + shifts[:, None]
            codes = bucket_codes(np.floor(values / width).astype(np.int64))
            for t in range(tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, t), pa.int32()), pa.array(codes[t]), *batch.columns],
                    names=["table", "bucket", *batch.schema.names])

    def probe(batches):
        for batch in batches:
            units = _units(_matrix(batch.column("vec"), size))
            for start in range(0, len(units), 64):
                rows, marks, codes = [], [], []
                values = np.einsum("ns,tsh->nth", units[start:start + 64], axes) + shifts
                for k in range(len(values)):
                    for t in range(tables):
                        visited = bucket_codes(probe_order(values[k, t], width, radius, success))
                        rows.append(np.full(len(visited), start + k))
                        marks.append(np.full(len(visited), t))
                        codes.append(visited)
                picked = batch.take(pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(marks), pa.int32()), pa.array(np.concatenate(codes)), *picked.columns],
                    names=["table", "bucket", *batch.schema.names])

    entries = distinct.mapInArrow(index, "table int, bucket long, rep long, ids array<long>, vec array<double>")
    probes = asked.mapInArrow(probe, "table int, bucket long, query_id long, vec array<double>")
    best = settle(_best(_by_parts(probes, entries, rows, size, count), count))
    short = asked.join(best.where(F.col("rank") == count).select("query_id"), "query_id", "left_anti")
    if short.isEmpty():
        return best
    # Too few candidates: one bucket that holds all vectors.
    everything = lambda df: df.select(F.lit(0).alias("table"), F.lit(0).cast("long").alias("bucket"), "*")
    rest = _best(_by_parts(everything(short), everything(distinct), rows, size, count), count)
    return best.join(short.select("query_id"), "query_id", "left_anti").unionByName(rest)
