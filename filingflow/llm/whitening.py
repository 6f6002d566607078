"""Embedding whitening by shifted Cholesky QR.

Entries become whole numbers, x = floor(scale * c) + offset, so the sums per
dimension are exact. With A the rows x - S/n, passes over the stored rows add
up Gram matrices of bounded size: the first gives an R factor by a Cholesky
decomposition of A'A plus a small shift (which makes it succeed for any
conditioning), each further one decomposes the Gram matrix of the rows solved
through the triangles found so far. The composed factor R satisfies A = QR
with orthonormal Q; its singular value decomposition has A's singular values
and right vectors, which are the components.

What leaves a task is one partial sum per partition; those are added up in
``FOLDS`` tasks before the driver sees them, so the driver holds FOLDS matrices
whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import one_array, prepare, stored

#: Gram passes: a shifted one, and two that restore orthogonality
PASSES = 3
#: tasks that add up the partitions' partial sums
FOLDS = 8
#: entries beyond this can't be held exactly in a double
EXACT = 2.0 ** 53


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> DataFrame:
    """(id, x) of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    x = F.transform(v, lambda c: F.floor(c * F.lit(float(scale))) + F.lit(offset))
    usable = F.forall(v, lambda c: F.coalesce(F.abs(c * F.lit(float(scale))) < F.lit(EXACT - abs(offset)) , F.lit(False)) & ~F.isnan(F.coalesce(c, F.lit(float("nan")))))
    good = rows.where(v.isNotNull() & (F.size(v) > 0) & usable)
    lengths = good.groupBy(F.size(v).alias("size")).count()
    common = lengths.agg(F.max_by("size", F.struct("count", "size"))).first()[0]
    return good.where(F.size(v) == F.lit(common or 0)).select(F.col(id_col).alias("id"), x.cast("array<bigint>").alias("x"))


def matrix_of(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    """The x vectors of a batch, a row each."""
    lists = one_array(batch.column("x"))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def total(rows: DataFrame, measure: Callable[[np.ndarray], np.ndarray], dtype: type) -> np.ndarray | None:
    """Sum of ``measure`` (an array of fixed shape) over batches of vectors."""

    def add(batches: Iterator[pa.RecordBatch], of: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for part in of(batch) if batch.num_rows else ():
                held = part if held is None else held + part
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held.astype(dtype).tobytes()], pa.binary())], names=["part"])

    def first(batches):
        return add(batches, lambda b: iter([measure(matrix_of(b)).ravel()]))

    def again(batches):
        return add(batches, lambda b: (np.frombuffer(p, dtype) for p in b.column("part").to_pylist()))

    folded = rows.select("x").mapInArrow(first, "part binary").repartition(FOLDS).mapInArrow(again, "part binary")
    parts = [np.frombuffer(r["part"], dtype) for r in folded.collect()]
    return sum(parts[1:], parts[0]) if parts else None


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Q with Q @ upper == rows, by substitution from the first column on."""
    out = np.empty_like(rows)
    for j in range(upper.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def orthogonalised(x: np.ndarray, mean: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    q = x.astype(np.float64) - mean
    for r in factors:
        q = solved(q, r)
    return q


def gram(x: np.ndarray, mean: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    q = orthogonalised(x, mean, factors)
    return q.T @ q


def upper_factor(g: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """R with R'R = g (plus the shift). Where g is singular to working
    precision, the shift is used in a later pass too."""
    d = g.shape[0]
    shift = 11 * (n * d + d * (d + 1)) * 2.0 ** -53 * np.trace(g)
    if not shifted:
        try:
            r = np.linalg.cholesky(g).T
            if r.diagonal().min() > d * 2.0 ** -26 * r.diagonal().max():
                return r
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(g + shift * np.eye(d)).T


def root_factor(g: np.ndarray) -> np.ndarray:
    """R with R'R = g for any positive semidefinite g: the last one of the
    composition, which need not be a triangle."""
    try:
        return np.linalg.cholesky(g).T
    except np.linalg.LinAlgError:
        e, w = np.linalg.eigh((g + g.T) / 2)
        return np.sqrt(np.maximum(e, 0))[:, None] * w.T


@dataclass
class Whitening:
    n: int
    sums: np.ndarray            # per dimension, exact
    components: np.ndarray      # a column each, by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([int(s) / self.n for s in self.sums])

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float64) - self.mean) @ self.components / np.sqrt(self.eigenvalues)


def fit(rows: DataFrame, keep: int) -> Whitening | None:
    """The first ``keep`` components of stored (id, x) rows."""
    n = rows.count()
    if not n:
        return None
    sums = total(rows, lambda x: x.sum(axis=0), np.int64)
    d = len(sums)
    mean = np.array([int(s) / n for s in sums])
    factors: list[np.ndarray] = []
    spread = 0.0
    for k in range(PASSES):
        g = total(rows, partial(gram, mean=mean, factors=list(factors)), np.float64).reshape(d, d)
        if k == 0:
            spread = float(np.trace(g))
            if spread == 0:
                return Whitening(n, sums, np.empty((d, 0)), np.empty(0), 0.0)
        factors.append(upper_factor(g, n, k == 0) if k < PASSES - 1 else root_factor(g))
    r = np.eye(d)
    for f in factors:
        r = f @ r
    _, values, vectors = np.linalg.svd(r)
    rank = int((values > max(n, d) * 2.0 ** -52 * values[0]).sum())
    v = vectors[:min(keep, rank)].T
    v = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1.0, 1.0)
    return Whitening(n, sums, v, values[:v.shape[1]] ** 2 / n, spread / n)


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the
    identity, measured on all rows."""
    k = len(w.eigenvalues)

    def moments(x: np.ndarray) -> np.ndarray:
        y = w.apply(x)
        return np.vstack([y.T @ y, y.sum(axis=0)])

    m = total(rows, moments, np.float64).reshape(k + 1, k) / w.n
    return float(np.abs(m[:k] - np.outer(m[k], m[k]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n * x - S)^2; null where it exceeds 64 bits.
    Integer arithmetic wraps, so a total below 2^63 is exact."""
    with np.errstate(over="ignore"):
        away = n * x - sums
        exact = (away * away).sum(axis=1)
    rough = ((n * (x - np.array([int(s) / n for s in sums]))) ** 2).sum(axis=1)
    fits = rough < 2.0 ** 63 * (1 - 1e-9)
    for i in np.flatnonzero(~fits & (rough < 2.0 ** 63 * (1 + 1e-9))):
        fits[i] = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums)) < 2 ** 63
    return pa.array(exact, pa.int64(), mask=~fits)


def whiten(vectors: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100_000,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector that takes part: vec_id, n, deviation, whitened
    (array of up to ``components`` doubles), explained (array: share of each
    component in the trace), identity_error.

    Vectors that are null or empty, hold null or non-finite entries or entries
    whose x is beyond 53 bits, or have another length than the commonest one
    (ties: the longer) take no part. A null id is kept; repeated rows count as
    often as they come; other columns are ignored. There are as many components
    as V has eigenvalues above rounding (n * 2^-52 of the largest singular
    value), ``components`` at most: none for equal vectors or a single one.
    Component signs make the largest entry positive. ``deviation`` is null
    where it exceeds a long. An empty table gives an empty result.
    """
    spark = prepare(vectors.sparkSession)
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = stored(whole_vectors(vectors, id_col, vector_col, scale, offset), "whitening")
    w = fit(rows, components)
    schema = f"vec_id {kind}, n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double"
    if w is None:
        return spark.createDataFrame([], schema)
    error = identity_error(rows, w) if len(w.eigenvalues) else 0.0
    explained = (w.eigenvalues / w.trace).tolist() if w.trace else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix_of(batch)
                y = w.apply(x)
                ends = pa.array(np.arange(len(x) + 1) * y.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("id"), deviations(x, w.n, w.sums),
                                                  pa.ListArray.from_arrays(ends, pa.array(y.ravel(), pa.float64()))],
                                                 names=["vec_id", "deviation", "whitened"])

    out = rows.mapInArrow(run, f"vec_id {kind}, deviation bigint, whitened array<double>")
    return out.select("vec_id", F.lit(w.n).cast("bigint").alias("n"), "deviation", "whitened",
                      F.array(*map(F.lit, explained)).cast(T.ArrayType(T.DoubleType())).alias("explained"), F.lit(error).alias("identity_error"))
