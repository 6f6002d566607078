"""Approximate nearest neighbours with an adaptive scan of dimensions.

Vectors are rotated by a random orthogonal matrix, which spreads a distance
evenly over the dimensions, and put into lists by their nearest centroid.
A query scans its ``probes`` nearest lists, in two rounds: the few nearest
ones, about ``FIRST_ROWS`` times k vectors, give it a k-th best distance, which
it carries into the others. Inside a list, distances grow by blocks of columns:
after d of D dimensions the partial distance, scaled up, is an estimate of the
whole, and a candidate is abandoned once the estimate exceeds the k-th best
distance so far by more than chance allows (a hypothesis test with parameter
``EPSILON``). Survivors are measured exactly, in double precision on the
original vectors.

Rotation and centroids are fit on a bounded sample (``train_rows``); every
vector is indexed. Lists are cut into slices of bounded size by a hash of the
id, so a list that holds a third of all vectors is many tasks, and so are the
queries of a list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import one_array, prepare, stored

#: dimensions per step, and the test's width: the larger, the fewer abandoned
STEP, EPSILON = 16, 1.2
#: vectors of a slice, and queries that scan it at once
SLICE_ROWS, SLICE_QUERIES = 32768, 8192
#: vectors that a query looks at in its first round, and measures whole before
#: it has a k-th best distance, both times k; vectors tested at once
FIRST_ROWS, FIRST_CHUNK, CHUNK = 8, 4, 1024
MOST_LISTS = 1024
#: share of the lists that a query probes: vectors without clusters need most
PROBE_SHARE = 0.75


def usable(vector: Column, dimensions: int | None = None) -> Column:
    """Whether a vector takes part: not null, not zero, all components finite,
    and of the given number of dimensions."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    return F.coalesce(good if dimensions is None else good & (F.size(vector) == dimensions), F.lit(False))


class ListIndex:
    """A rotation and the centroids of the lists, in rotated space."""

    def __init__(self, sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.rotation = np.linalg.qr(rng.standard_normal((sample.shape[1], sample.shape[1])))[0]
        x = sample @ self.rotation
        c = x[np.sort(rng.permutation(len(x))[:lists])].copy()
        for _ in range(rounds):
            near = self._near(x, c, 1)[:, 0]
            for j in range(len(c)):
                own = x[near == j]
                if len(own):
                    c[j] = own.mean(axis=0)
        self.centroids = c

    @staticmethod
    def _near(x: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
        d = (c ** 2).sum(axis=1)[None, :] - 2 * x @ c.T
        n = min(n, len(c))
        if n == 1:
            return d.argmin(axis=1)[:, None]
        return np.argpartition(d, n - 1, axis=1)[:, :n]

    def nearest_lists(self, rotated: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` nearest lists of each vector, nearest first."""
        def some(x: np.ndarray) -> np.ndarray:
            d = (self.centroids ** 2).sum(axis=1)[None, :] - 2 * x @ self.centroids.T
            return np.argsort(d, axis=1, kind="stable")[:, :n]
        return np.concatenate([some(rotated[a:a + 4096]) for a in range(0, len(rotated), 4096)] or [np.empty((0, n), np.int64)])

    def lists_of(self, rotated: np.ndarray, n: int) -> np.ndarray:
        return np.concatenate([self._near(rotated[a:a + 4096], self.centroids, n) for a in range(0, len(rotated), 4096)] or [np.empty((0, 1), np.int64)])


def scan(queries: np.ndarray, rotated: np.ndarray, original: np.ndarray, query_original: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int,
         limits: np.ndarray | None = None, skipped: list[int] | None = None):
    """For each query the positions and distances of its ``k`` nearest among
    the candidates, by the adaptive scan. ``ids`` are in order, so that ties
    go to the smaller. ``limits`` are the queries' k-th best distances so far;
    ``skipped`` gets the dimensions that the test left out, and all."""
    d = rotated.shape[1]
    left_out = 0
    for q in range(len(queries)):
        best_at, best = np.empty(0, np.int64), np.empty(0)
        carried = np.inf if limits is None else limits[q]
        a = 0
        while a < len(rotated):
            limit = min(carried, best[-1] if len(best) == k else np.inf)
            stop_at = min(len(rotated), a + (CHUNK if limit < np.inf else FIRST_CHUNK * k))
            alive = np.arange(a, stop_at)
            alive = alive[ids[alive] != own[q]]
            a = stop_at
            if limit < np.inf:
                partial = np.zeros(len(alive))
                for b in range(0, d, STEP):
                    stop = min(b + STEP, d)
                    partial += ((rotated[alive, b:stop] - queries[q, b:stop]) ** 2).sum(axis=1)
                    slack = 1 + EPSILON / np.sqrt(stop) if stop < d else 1 + 1e-6
                    stay = np.sqrt(partial * (d / stop)) <= limit * slack + 1e-12
                    if not stay.all():
                        left_out += int((~stay).sum()) * (d - stop)
                        alive, partial = alive[stay], partial[stay]
                    if not len(alive):
                        break
            if len(alive):
                far = np.sqrt(((original[alive] - query_original[q]) ** 2).sum(axis=1))
                at, far = np.concatenate([best_at, alive]), np.concatenate([best, far])
                order = np.lexsort((ids[at], far))[:k]
                best_at, best = at[order], far[order]
        yield best_at, best
    if skipped is not None:
        skipped[0] += left_out
        skipped[1] += len(queries) * len(rotated) * d


def nearest_vectors(rows: DataFrame, is_query: Column, k: int = 10, train_rows: int = 20_000, lists: int | None = None, probes: int | None = None,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest vectors found for every row for which ``is_query``
    holds: query_id, rank (from 1), vec_id, score (the Euclidean distance);
    nearest first, ties to the smaller id, the query's own id left out.

    By default there are about sqrt(n) lists (MOST_LISTS at most) and
    PROBE_SHARE of them are probed. Vectors that are null, zero, or hold null or
    non-finite components, those of another length than most, and null ids
    take no part; rows that repeat id and vector count once; an empty table
    gives an empty result.
    """
    spark = prepare(rows.sparkSession)
    vectors = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("asks"))
    vectors = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    sizes = vectors.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    vectors = vectors.where(F.size("v") == sizes["d"]).distinct()
    n_lists = lists or int(min(MOST_LISTS, max(1, round(sizes["n"] ** 0.5))))
    sample = vectors.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(train_rows).toArrow()
    fitted = ListIndex(one_array(sample.column("v")).flatten().to_numpy().reshape(-1, sizes["d"]), n_lists)
    probes = min(len(fitted.centroids), probes or math.ceil(PROBE_SHARE * len(fitted.centroids)))
    index = spark.sparkContext.broadcast(fitted)  # at most MOST_LISTS centroids

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
                own = index.value.lists_of(x @ index.value.rotation, 1)[:, 0]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, pa.int32())], names=["vec_id", "v", "asks", "list"])

    placed = stored(vectors.mapInArrow(place, "vec_id long, v array<double>, asks boolean, list int"), "lists")

    first = min(probes, max(1, math.ceil(FIRST_ROWS * k * len(fitted.centroids) / sizes["n"])))

    def probing(lo: int, hi: int):
        """Each query's lists number lo to hi, by nearness."""
        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
                    near = index.value.nearest_lists(x @ index.value.rotation, hi)[:, lo:]
                    row = pa.array(np.repeat(np.arange(b.num_rows), near.shape[1]))
                    yield pa.RecordBatch.from_arrays([*[b.column(i).take(row) for i in range(3)], pa.array(near.ravel(), pa.int32())],
                                                     names=["query_id", "q", "reach", "list"])
        return probe

    counts = stored(placed.groupBy("list").agg(F.count("*").alias("n"), F.count_if("asks").alias("asks")), "list-sizes")
    asks = placed.where("asks").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))

    def dealt(df: DataFrame, cut: DataFrame, id_: str, own: str, other: str) -> DataFrame:
        return (df.join(cut, "list").withColumn(own[:-1], F.pmod(F.xxhash64(id_), F.col(own)).cast("int"))
                .withColumn(other[:-1], F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("row_slices", "query_slices"))

    d = sizes["d"]

    def search(key, a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if a.num_rows and b.num_rows:
            ids = one_array(a.column("vec_id")).to_numpy()
            v = one_array(a.column("v")).flatten().to_numpy().reshape(-1, d)
            order = np.argsort(ids, kind="stable")
            ids, v = ids[order], v[order]
            q = one_array(b.column("q")).flatten().to_numpy().reshape(-1, d)
            own = one_array(b.column("query_id")).to_numpy()
            turn = index.value.rotation
            reach = one_array(b.column("reach")).to_numpy()
            for i, (at, far) in enumerate(scan(q @ turn, v @ turn, v, q, ids, own, k, reach)):
                out[0].append(np.full(len(at), own[i]))
                out[1].append(ids[at])
                out[2].append(far)
        joined = [np.concatenate(x) if x else np.empty(0) for x in out]
        return pa.table({"query_id": pa.array(joined[0], pa.int64()), "vec_id": pa.array(joined[1], pa.int64()), "score": pa.array(joined[2], pa.float64())})

    unit = ["list", "row_slice", "query_slice"]
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")

    def best(found: DataFrame) -> DataFrame:
        once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def round_(queries: DataFrame, lo: int, hi: int) -> DataFrame:
        """What the queries (query_id, q, reach) find in their lists lo to hi."""
        # slices per list, from counts: a row per list at most
        cut = F.broadcast(counts.select("list", F.ceil(F.col("n") / SLICE_ROWS).cast("int").alias("row_slices"),
                                        F.greatest(F.lit(1), F.ceil(F.col("asks") * (hi - lo) / SLICE_QUERIES)).cast("int").alias("query_slices")))
        asked = queries.select("query_id", "q", "reach").mapInArrow(probing(lo, hi), "query_id long, q array<double>, reach double, list int")
        left = dealt(placed.select("vec_id", "v", "list"), cut, "vec_id", "row_slices", "query_slices")
        right = dealt(asked, cut, "query_id", "query_slices", "row_slices")
        return left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInArrow(search, "query_id long, vec_id long, score double")

    near = stored(best(round_(asks.withColumn("reach", F.lit(math.inf)), 0, first)), "first-round")
    if first == probes:
        return near.select("query_id", "rank", "vec_id", "score")
    # a query without k neighbours yet goes on without a limit
    limits = near.where(F.col("rank") == k).select("query_id", F.col("score").alias("reach"))
    more = asks.join(limits, "query_id", "left").withColumn("reach", F.coalesce("reach", F.lit(math.inf)))
    return best(near.select("query_id", "vec_id", "score").union(round_(more, first, probes))).select("query_id", "rank", "vec_id", "score")
