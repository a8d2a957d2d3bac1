"""Approximate nearest neighbours by an inverted multi-index, for the largest inner product.

Both halves of the vectors are quantised apart, with codebooks that grow with the root of the
number of vectors, up to ``MOST_CENTROIDS``, fitted on a bounded sample (``TRAIN_ROWS``); a
vector's list is the pair of its centroids.  A query goes through the pairs in order of
summed distance until the lists it has gone through hold ``share`` of all vectors, or
``candidates`` if that's given; their entries are ranked by the exact inner product, in
double precision, ties to the smaller id.

Every vector is indexed.  Lists with one first centroid lie together, in blocks of bounded
size, so that a hot list is many blocks; queries are sent to the blocks that they visit, with
the second centroids visited there.  A task holds the vectors of one block, and queries go
past them a few at a time, each with the score that it has found so often already in blocks
before; only beyond ``QUERIES_A_BLOCK`` queries are blocks repeated.

Vectors that are null, empty, zero, of another length than most, or hold null or non-finite
components take no part, nor do rows without an id; a repeated id is as many candidates, and
each of its rows, where it's a query, finds the same.  Empty tables give no rows; columns
other than those named are ignored, whatever their names.  On vectors without clusters, near
neighbours are in all directions: ``share`` must be high for a high recall.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .durable import cut, tidy

#: Bound of the sample that the codebooks are fitted on.
TRAIN_ROWS = 8192
#: Vectors to each square of the number of centroids, and its bounds.
VECTORS_A_PAIR, LEAST_CENTROIDS, MOST_CENTROIDS = 2, 16, 512
#: Vectors that a task holds, queries that go past them together, queries for which a block is sent once.
VECTORS_A_BLOCK, QUERIES_AT_ONCE, QUERIES_A_BLOCK = 4096, 256, 8192
#: Queries of which a task remembers the scores that suffice.
BOUNDS_HELD = 200_000


def fit_codebook(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means; centroids start from distinct rows spread by distance."""
    rng = np.random.default_rng(0)
    distinct = np.unique(rows, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        near = nearest(rows, centres)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = rows[near == c].mean(0)
    return centres


def centroids_for(vectors: int) -> int:
    return min(MOST_CENTROIDS, max(LEAST_CENTROIDS, math.isqrt(vectors // VECTORS_A_PAIR)))


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of one component, the second half is a zero."""
    half = max(1, x.shape[1] // 2)
    return x[:, :half], x[:, half:] if x.shape[1] > 1 else np.zeros((len(x), 1))


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1)[None, :] - 2 * rows @ centres.T).argmin(1)


def visit(first: np.ndarray, second: np.ndarray, filled: np.ndarray, counts: np.ndarray, wanted: int) -> np.ndarray:
    """Places in ``filled`` of the pairs gone through by summed distance until their lists hold ``wanted`` entries.

    filled: pairs with entries, as first times the number of second centroids plus second; counts: their
    entries.  The order is that of a multi-sequence heap; where most pairs are gone through, as on vectors
    without clusters, one sort of all sums costs far less than a heap's steps.
    """
    order = np.argsort((first[:, None] + second[None, :]).ravel()[filled], kind="stable")
    return order[: np.searchsorted(np.cumsum(counts[order]), wanted) + 1]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector (array of double) of the rows that take part."""
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))


def search(vectors: DataFrame, is_query, k: int = 20, share: float = 0.6, candidates: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: of each row for which ``is_query`` (a column of vec_id) holds."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = valid(vectors, id_col, vector_col)
    lengths = rows.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if lengths is None:
        return empty
    dim, total = lengths["dim"], lengths["n"]
    rows, centroids = rows.filter(F.size("vector") == dim), centroids_for(total)
    draw = F.xxhash64(F.lit("codebook"), "vec_id")
    lot = F.pmod(draw, F.lit(1_000_000)) / 1e6 < F.lit(TRAIN_ROWS / total)
    drawn = rows.select("vec_id", "vector").orderBy(draw, "vec_id", "vector")  # reruns take the same rows
    sample = drawn.filter(lot).limit(4 * TRAIN_ROWS).collect() or drawn.limit(1).collect()
    sample = np.array([r["vector"] for r in sorted(sample, key=lambda r: (r["vec_id"], r["vector"]))])
    books = spark.sparkContext.broadcast(tuple(fit_codebook(x, centroids) for x in halves(sample)))

    @tidy
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = books.value
        for batch in batches:
            left, right = halves(_matrix(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest(left, one).astype(np.int32)), pa.array(nearest(right, two).astype(np.int32))], names=["vec_id", "vector", "c1", "c2"])

    index = cut(rows.mapInArrow(place, "vec_id long, vector array<double>, c1 int, c2 int"))
    counts = np.zeros((len(books.value[0]), len(books.value[1])), np.int64)
    for r in index.groupBy("c1", "c2").agg(F.count("*").alias("n")).collect():
        counts[r["c1"], r["c2"]] = r["n"]
    queries = index.filter(is_query(F.col("vec_id"))).select("vec_id", "vector")
    n_queries = queries.count()
    wanted = min(total, (math.ceil(share * total) if candidates is None else candidates) + k + 1)
    sizes = spark.sparkContext.broadcast(counts)

    @tidy
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = books.value
        filled = np.flatnonzero(sizes.value)
        held = sizes.value.ravel()[filled]
        for batch in batches:
            left, right = halves(_matrix(batch.column(1), dim))
            for i in range(len(left)):
                first, second = np.divmod(filled[np.sort(visit(-(one @ left[i]), -(two @ right[i]), filled, held, wanted))], len(two))
                start = np.flatnonzero(np.diff(first, prepend=-1))
                visits = pa.ListArray.from_arrays(pa.array(np.append(start, len(second)).astype(np.int32)), pa.array(second.astype(np.int32)))
                at = pa.array(np.full(len(start), i, np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(first[start].astype(np.int32)), visits], names=["vec_id", "vector", "c1", "visits"])

    parts = {a: max(1, -(-int(n) // VECTORS_A_BLOCK)) for a, n in enumerate(counts.sum(1))}
    asking = max(1, -(-n_queries // QUERIES_A_BLOCK))
    n_parts = F.element_at(F.array(*(F.lit(parts[a]) for a in range(len(parts)))), F.col("c1") + 1)
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    listed = index.select("c1", F.pmod(F.xxhash64("vec_id"), n_parts).cast("int").alias("part"), upto(F.lit(asking)).alias("asking"), F.lit(0).alias("role"), "vec_id", "vector", F.array("c2").alias("visits"))
    asked = queries.mapInArrow(route, "vec_id long, vector array<double>, c1 int, visits array<int>")
    asked = asked.select("c1", upto(n_parts).alias("part"), F.pmod(F.xxhash64(F.lit("asking"), "vec_id"), F.lit(asking)).cast("int").alias("asking"), F.lit(1).alias("role"), "vec_id", "vector", "visits")

    @tidy
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's vectors come first and are held; queries are ranked as they come."""
        key, parts, held, bounds = None, [], None, {}
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
            at = 0
            for i in range(1, len(keys) + 1):
                if i < len(keys) and keys[i] == keys[at]:
                    continue
                *block, role = keys[at]
                if block != key:
                    key, parts, held = block, [], None
                if role == 0:
                    parts.append(batch.slice(at, i - at))
                elif parts or held:
                    if held is None:
                        held, parts = block_of(parts), []
                    if len(bounds) > BOUNDS_HELD:
                        bounds = {}
                    for q in range(at, i, QUERIES_AT_ONCE):
                        yield from rank(batch.slice(q, min(QUERIES_AT_ONCE, i - q)), *held, bounds)
                at = i

    def block_of(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.concatenate([p.column(4).to_numpy() for p in parts])
        c2 = np.concatenate([p.column(6).flatten().to_numpy() for p in parts])
        return ids, np.concatenate([_matrix(p.column(5), dim) for p in parts]), c2

    def rank(asked: pa.RecordBatch, ids: np.ndarray, v: np.ndarray, c2: np.ndarray, bounds: dict[int, float]) -> Iterator[pa.RecordBatch]:
        """bounds: by query, a score that k entries of blocks before this one reach; what falls short of it is of no use."""
        asking_ids, q = asked.column(4).to_numpy(), _matrix(asked.column(5), dim)
        goes = np.zeros((len(q), centroids), bool)
        goes[np.repeat(np.arange(len(q)), asked.column(6).value_lengths().to_numpy()), asked.column(6).flatten().to_numpy()] = True
        near = q @ v.T
        near[~goes[:, c2] | (asking_ids[:, None] == ids[None, :])] = -np.inf
        # The product orders; what is near the k-th is scored again, in one fixed order of summation.
        kth = np.partition(near, len(v) - k, axis=1)[:, len(v) - k] if len(v) > k else np.full(len(q), -np.inf)
        least = np.maximum(kth, [bounds.get(i, -np.inf) for i in asking_ids.tolist()])
        bounds.update(zip(asking_ids.tolist(), least.tolist(), strict=True))
        a, b = np.nonzero((near >= np.where(least > -np.inf, least - 1e-9 * np.maximum(1, np.abs(least)), -np.inf)[:, None]) & (near > -np.inf))
        score = np.concatenate([(q[a[s : s + 50_000]] * v[b[s : s + 50_000]]).sum(1) for s in range(0, max(1, len(a)), 50_000)])
        order = np.lexsort((ids[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        top = np.arange(len(a)) - np.searchsorted(a, np.arange(len(q)))[a] < k
        if top.any():
            yield pa.RecordBatch.from_arrays([pa.array(asking_ids[a[top]]), pa.array(ids[b[top]]), pa.array(score[top])], names=["query_id", "vec_id", "score"])

    keys = ["c1", "part", "asking"]
    found = listed.unionByName(asked).repartition(*keys).sortWithinPartitions(*keys, "role").mapInArrow(meet, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
