"""Exact top-k search by inner product over a pivot-distance index.

Vectors of integers are lifted by one coordinate so that all have the same
norm R (queries get 0 there); then |q' - v'|^2 = |q|^2 + R^2 - 2 <q, v>, and
the k largest inner products are the k nearest lifted vectors.

* Index: pivots are picked by farthest-first traversal of a bounded sample
  (``SAMPLE`` vectors).  Every vector is keyed by its nearest pivot and its
  distance to it, range-partitioned and sorted by (pivot, distance), and stored
  in blocks of up to ``BLOCK`` vectors with the block's least and greatest
  distance.  One very frequent vector fills many blocks, in many tasks.
* Search: a block lies in an annulus around its pivot, so by the triangle
  inequality every vector of it is at least max(0, low - d, d - high) from a
  query at distance d of the pivot.  A task expands annuli in rising order of
  that bound, and stops for a query once the bound exceeds the distance of its
  k-th best so far.

Queries are taken in batches of at most ``QUERIES`` rows, each one sent to
all tasks (QUERIES * dimension * 8 bytes), so nothing that grows with the
table is broadcast; tasks return at most k rows per query, merged by a window.

Edge cases: vectors that are null, hold null or non-finite components, are
empty, or have another length than most vectors take no part, nor does a null
vec_id.  Rows that repeat a vec_id are separate candidates, and the greatest
of their vectors asks the query; a query's own
vec_id is never its candidate.  Ties go to the smaller vec_id.  Fewer than k
candidates are all returned.  An empty table gives no row.  Other columns are
ignored.  Large finite components are summed exactly: in doubles, 64-bit words or
Python's integers, as the greatest norm needs; components and scores beyond a long
are set to the nearest long.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import batches, prepare, written

K = 10
SCALE = 1024
EVERY = 100
PIVOTS = 32
#: Sampled vectors that pivots are picked from.
SAMPLE = 4096
BLOCK = 512
QUERIES = 2048

BLOCKS = "pivot int, low double, high double, n int, ids binary, vectors binary"
FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v = floor(scale * x) of the vectors that take part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.select("vec_id", "embedding").where(F.coalesce(fine, F.lit(False))).select(
        "vec_id", F.transform(x, lambda c: F.floor(c * scale)).alias("v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, dim)


def farthest_first(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots: each next one is the sampled vector farthest from those before."""
    chosen = [0]
    gap = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(sample)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def lift(v: np.ndarray, norm2: float) -> np.ndarray:
    """One more coordinate that makes every squared norm ``norm2``."""
    v = v.astype(float)
    last = np.sqrt(np.maximum(0, norm2 - (v * v).sum(1)))
    return np.concatenate([v, last[:, None]], 1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(0, square))


def build_index(rows: DataFrame, dim: int, norm2: float, pivots: np.ndarray) -> DataFrame:
    """Blocks of all vectors, sorted by (pivot, distance) within ranges."""

    def key(source):
        for batch in batches(source):
            d = distances(lift(matrix(batch.column(1), dim), norm2), pivots)
            near = d.argmin(1)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(0).cast(pa.int64()), "v": batch.column(1),
                "pivot": pa.array(near.astype(np.int32)), "distance": pa.array(d[np.arange(len(near)), near])})

    keyed = rows.mapInArrow(key, "vec_id long, v array<long>, pivot int, distance double")
    keyed = keyed.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id")

    def blocks(source):
        for batch in batches(source):
            pivot = batch.column("pivot").to_numpy()
            d = batch.column("distance").to_numpy()
            v = matrix(batch.column("v"), dim)
            ids = batch.column("vec_id").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(pivot)) + 1).tolist(), len(pivot)]
            parts = [(a, min(a + BLOCK, z)) for y, z in zip(cuts, cuts[1:]) for a in range(y, z, BLOCK)]
            yield pa.RecordBatch.from_pydict({
                "pivot": pa.array([pivot[a] for a, _ in parts], pa.int32()),
                "low": pa.array([d[a] for a, _ in parts]), "high": pa.array([d[z - 1] for _, z in parts]),
                "n": pa.array([z - a for a, z in parts], pa.int32()),
                "ids": pa.array([ids[a:z].astype("<i8").tobytes() for a, z in parts], pa.binary()),
                "vectors": pa.array([v[a:z].astype("<i8").tobytes() for a, z in parts], pa.binary())})

    return keyed.mapInArrow(blocks, BLOCKS)


def expand(source, queries: np.ndarray, query_ids: np.ndarray, pivots: np.ndarray, norm2: float, k: int):
    """The k best candidates of every query within one task's blocks."""
    floats = queries.astype(float)
    to_pivot = distances(np.concatenate([floats, np.zeros((len(queries), 1))], 1), pivots)
    square = (floats * floats).sum(1)
    slack = 1e-6 * np.sqrt(norm2 + square + 1)
    best: list[list[tuple[int, int]]] = [[] for _ in queries]  # heaps of (score, -vec_id)
    reach = np.full(len(queries), np.inf)  # distance of the k-th best
    dim = queries.shape[1]
    # no part of a product's sum exceeds the greatest norm
    exact_in_floats = norm2 < 2 ** 52 and square.max() < 2 ** 52
    exact_in_longs = norm2 < 2 ** 62 and square.max() < 2 ** 62

    def products(rows, v):
        if exact_in_floats:
            return (floats[rows] @ v.T.astype(float)).astype(np.int64)
        if exact_in_longs:
            return queries[rows] @ v.T
        return queries[rows].astype(object) @ v.T.astype(object)

    def visit(block):
        pivot, low, high, n, ids, vectors = block
        d = to_pivot[:, pivot]
        bound = np.maximum(0, np.maximum(low - d, d - high))
        active = np.flatnonzero(bound <= reach + slack)
        if not len(active):
            return
        ids = np.frombuffer(ids, "<i8")
        v = np.frombuffer(vectors, "<i8").reshape(-1, dim)
        score = products(active, v)
        for row, q in enumerate(active.tolist()):
            heap = best[q]
            other = np.flatnonzero(ids != query_ids[q])  # any number of rows may repeat the query's id
            own = score[row][other]
            if len(heap) == k:
                hits = np.flatnonzero(own >= heap[0][0])
            elif len(own) > 4 * k:
                hits = np.flatnonzero(own >= np.partition(own, len(own) - k)[len(own) - k])
            else:
                hits = np.arange(len(own))
            for i in hits.tolist():
                item = (int(own[i]), -int(ids[other[i]]))
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
            if len(heap) == k:
                reach[q] = np.sqrt(max(0.0, square[q] + norm2 - 2 * heap[0][0]))

    for batch in batches(source):
        held = list(zip(*(c.to_pylist() for c in batch.columns)))
        # sorted annuli: the nearest ones to any query first
        nearest = [float(np.maximum(0, np.maximum(b[1] - to_pivot[:, b[0]], to_pivot[:, b[0]] - b[2])).min()) for b in held]
        for i in np.argsort(nearest, kind="stable").tolist():
            visit(held[i])
    found = [(int(query_ids[q]), -i, min(max(s, -2 ** 63), 2 ** 63 - 1)) for q, heap in enumerate(best) for s, i in heap]
    if found:
        a, b, c = zip(*found)
        yield pa.RecordBatch.from_pydict({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()),
                                          "score": pa.array(c, pa.int64())})


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every vector whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    prepare(spark)
    rows, _ = written(quantised(vectors, scale), "op1-vectors")
    common = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if common is None:
        return empty
    dim = common["dim"]
    rows = rows.where(F.size("v") == dim)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    norm2 = rows.agg(F.max(norm)).first()[0]
    picked = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).toArrow()
    sample = np.array(picked.column("v").to_pylist(), np.int64)
    pivots = farthest_first(lift(sample, norm2), PIVOTS)
    index, _ = written(build_index(rows, dim, norm2, pivots), "op1-index")

    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.max("v").alias("v"))
    number = asked.count()
    if not number:
        return empty
    groups = -(-number // QUERIES)
    asked, _ = written(asked.repartitionByRange(groups, "vec_id").withColumn("batch", F.spark_partition_id()), "op1-queries")
    found = None
    for g in range(groups):
        own = asked.where(F.col("batch") == g).toArrow()  # about QUERIES rows
        if not own.num_rows:
            continue
        ids = own.column("vec_id").to_numpy()
        shared = spark.sparkContext.broadcast((np.array(own.column("v").to_pylist(), np.int64), ids, pivots))
        part = index.mapInArrow(
            lambda source, shared=shared: expand(source, shared.value[0], shared.value[1], shared.value[2], norm2, k), FOUND)
        found = part if found is None else found.union(part)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
