"""Whitening of embeddings by principal components, from a covariance in two passes.

The entries are put on a grid of integers first: floor(``scale`` * c) + ``offset``.  The first
pass adds these up exactly; the sums give the mean.  The second adds up outer products of the
centred vectors, a NumPy product for each batch and one matrix for each task, which
treeAggregate merges; LAPACK's symmetric eigh on the driver gives the components, and the
projection, dimensions by components, is sent to the tasks.  A third pass measures the
covariance of the whitened vectors, each task's about its own mean and merged with the shift
of the means.  What the driver gets is bounded by the number of dimensions alone.

Vectors that are null or empty or hold null or non-finite entries take no part, nor do those
of another length than most (ties: the shortest), as no covariance with them exists, and those
with an entry of 2**56 or more, whose grid number doesn't fit a long.  All else is the fit
list, rows without an id and repeated rows included, each counted.  A component whose
eigenvalue is zero to rounding (constant dimensions, fewer vectors than components) has null
for ``whitened``; ``explained`` is null where the whole variance is zero.  Empty tables give no
rows; columns other than the id and the vector are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .durable import small_batches, tidy

#: Of an entry, so that its grid number fits a long.
MOST_ENTRY = 2.0**56
#: Vectors times components that are sent on together.
SENT_VALUES = 1 << 17
_DECIMAL = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Grid:
    scale: float = 64.0
    offset: int = 1_000_000

    def numbers(self, column: pa.Array, dim: int) -> np.ndarray:
        entries = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
        return np.floor(self.scale * entries).astype(np.int64) + self.offset


@dataclass(frozen=True)
class Whitening:
    """eigenvalues fall; projection: dimensions by components, zero for a component that can't be whitened."""

    grid: Grid
    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    projection: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def usable(self) -> np.ndarray:
        return (self.projection != 0).any(0)

    def explained(self) -> list[float | None]:
        return [float(e) / self.trace if self.trace > 0 else None for e in self.eigenvalues]


def taking_part(vectors: DataFrame, grid: Grid, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """id and vector of the rows that take part, and their length (0 if there are none)."""
    v, most = F.col("vector"), MOST_ENTRY * 64 / max(64.0, grid.scale)
    rows = vectors.select(F.col(id_col), F.col(vector_col).cast("array<double>").alias("vector"))
    fits = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < most))
    rows = rows.filter(F.coalesce(fits & (F.size(v) > 0), F.lit(False)))
    length = rows.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    dim = length["dim"] if length else 0
    return small_batches(rows.filter(F.size("vector") == dim)), dim


def merged(rows: DataFrame, zero, each: Callable[[object, np.ndarray], object], merge: Callable, read: Callable[[pa.Array], np.ndarray]):
    """``each`` folded over the matrices of every task, and the tasks' outcomes merged by treeAggregate."""
    import pickle

    @tidy
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, any_rows = zero, False
        for batch in batches:
            if len(batch):
                held, any_rows = each(held, read(batch.column(1))), True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(held)], pa.binary())], names=["held"])

    partial = rows.mapInArrow(fold, "held binary").rdd
    return partial.treeAggregate(zero, lambda held, row: merge(held, pickle.loads(row["held"])), merge)


def exact_sums(numbers: np.ndarray) -> list[int]:
    """Column sums as Python integers, in two halves so that no long overflows."""
    high, low = numbers >> 31, numbers & 0x7FFFFFFF
    return [(int(h) << 31) + int(x) for h, x in zip(high.sum(0), low.sum(0), strict=True)]


def centred(numbers: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """x - S/n: the whole part of the mean goes in integers, the rest in doubles."""
    whole, rest = zip(*(divmod(s, n) for s in sums), strict=True)
    return (numbers - np.array(whole, np.int64)).astype(np.float64) - np.array([r / n for r in rest])


def deviations(numbers: np.ndarray, sums: list[int], n: int) -> pa.Array:
    """Exact sums over the dimensions of (n * x - S)**2; null beyond 38 digits."""
    most = max(n * int(np.abs(numbers).max(initial=0)), *map(abs, sums)) * 2
    if most < 1 << 62:
        apart = n * numbers - np.array(sums, np.int64)
        if int(np.abs(apart).max(initial=0)) ** 2 * len(sums) < 1 << 63:
            return pa.array((apart * apart).sum(1)).cast(_DECIMAL)
        apart = apart.astype(object)
    else:
        apart = n * numbers.astype(object) - np.array(sums, object)
    totals = (apart * apart).sum(1)
    return pa.array([Decimal(int(t)) if t < 10**38 else None for t in totals], _DECIMAL)


def components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and the projection that whitens; each vector's largest entry is positive."""
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:k]
    values, vectors = values[order], vectors[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    usable = values > max(values[0], 0.0) * len(covariance) * np.finfo(float).eps
    return np.where(usable, values, 0.0), np.where(usable, vectors / np.sqrt(np.where(usable, values, 1.0)), 0.0)


def _moments(rows: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    mean = rows.mean(0)
    apart = rows - mean
    return len(rows), mean, apart.T @ apart


def _merged_moments(a: tuple | None, b: tuple | None) -> tuple | None:
    """Number, mean and sum of centred outer products of both together."""
    if a is None or b is None:
        return a or b
    n, shift = a[0] + b[0], b[1] - a[1]
    return n, a[1] + shift * (b[0] / n), a[2] + b[2] + np.outer(shift, shift) * (a[0] * b[0] / n)


def fit(vectors: DataFrame, k: int = 32, grid: Grid | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening | None:
    """The whitening of all rows that take part; None if there are none."""
    grid = grid or Grid()
    rows, dim = taking_part(vectors, grid, id_col, vector_col)
    if not dim:
        return None
    read = lambda column: grid.numbers(column, dim)
    add = lambda a, b: (a[0] + b[0], [x + y for x, y in zip(a[1], b[1], strict=True)])
    n, sums = merged(rows, (0, [0] * dim), lambda held, x: add(held, (len(x), exact_sums(x))), add, read)

    def product(held: np.ndarray | float, x: np.ndarray) -> np.ndarray:
        c = centred(x, sums, n)
        return held + c.T @ c

    covariance = merged(rows, 0.0, product, lambda a, b: a + b, read) / n
    values, projection = components(covariance, min(k, dim))
    model = Whitening(grid, n, sums, values, projection, float(np.trace(covariance)))
    if not model.usable.any():
        return model
    used = projection[:, model.usable]
    _, _, outer = merged(rows, None, lambda held, x: _merged_moments(held, _moments(centred(x, sums, n) @ used)), _merged_moments, read)
    error = float(np.abs(outer / n - np.eye(used.shape[1])).max())
    return Whitening(grid, n, sums, values, projection, model.trace, error)


def transform(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained and identity_error: a row for each vector and component.

    Vectors that ``fit`` would leave out, or of another length than the model's, give none.
    """
    kind = vectors.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows, _ = taking_part(vectors, model.grid, id_col, vector_col)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    @tidy
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.eigenvalues)
        usable, explained, step = model.usable, model.explained(), max(1, SENT_VALUES // k)
        for whole in batches:
            for at in range(0, len(whole), step):
                batch = whole.slice(at, step)
                x = model.grid.numbers(batch.column(1), model.dim)
                m = len(x)
                white = (centred(x, model.sums, model.n) @ model.projection).ravel()
                each = pa.array(np.repeat(np.arange(m), k))
                columns = [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    deviations(x, model.sums, model.n).take(each),
                    pa.array(white, mask=np.tile(~usable, m)),
                    pa.array(explained * m, pa.float64()),
                    pa.array([model.identity_error] * (m * k), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.filter(F.size("vector") == model.dim).mapInArrow(project, schema)
