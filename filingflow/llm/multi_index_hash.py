"""Exact top-k Hamming search over binary codes by incremental multi-index hashing.

A code of ``BITS`` bits is cut into ``SEGMENTS`` segments, and codes are
indexed by the value of each segment. A query looks up the values at segment
distance 0, then 1, and so on. Once every segment has been searched up to
distance r, each code within distance SEGMENTS x (r + 1) - 1 has been found
(pigeonhole), so the query stops as soon as its k-th verified distance is
covered by that.

Equal codes are one entry that keeps its k + 1 smallest ids, which is all a
query can use, so a code that a third of the rows share costs no more than any
other. Entries are dealt into shards by a hash; a shard is indexed in memory,
answers the queries in slices, and the shards' answers are merged by rank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import one_array, prepare, ragged_take, stored

BITS, SEGMENTS = 64, 4
WIDTH = BITS // SEGMENTS
#: entries of a shard, and queries that a shard answers at once
SHARD_CODES, SLICE_QUERIES = 200_000, 20_000

_VALUES = np.arange(1 << WIDTH, dtype=np.int64)
#: segment masks by number of bits
RINGS = [_VALUES[np.bitwise_count(_VALUES) == r] for r in range(WIDTH + 1)]


def sign_code(vector: Column) -> Column:
    """64-bit code of a vector: bit i is set if component i is above zero. Null
    for a null vector or one with a null or non-finite component. A usable
    vector of more than 64 components is an error: its nearest neighbours are
    not those of a prefix."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    bits = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    wide = F.raise_error(F.lit(f"a sign code has {BITS} bits, and a vector more components")).cast("long")
    return F.when(vector.isNotNull() & ~bad & (F.size(vector) > BITS), wide).when(vector.isNotNull() & ~bad, F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x)))


class SegmentIndex:
    """Codes by the value of each segment."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order, self.bounds = [], []
        for s in range(SEGMENTS):
            value = self.segment(codes, s)
            self.order.append(np.argsort(value, kind="stable"))
            self.bounds.append(np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << WIDTH))]))

    @staticmethod
    def segment(codes: np.ndarray, s: int) -> np.ndarray:
        return ((codes >> np.uint64(WIDTH * s)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)

    def search(self, query: np.uint64, enough) -> tuple[np.ndarray, np.ndarray]:
        """(entries, distances) of all entries met until ``enough(distances,
        entries, covered)`` holds or every entry has been met."""
        own = [int(self.segment(np.array([query], np.uint64), s)[0]) for s in range(SEGMENTS)]
        met = np.zeros(len(self.codes), bool)
        entries, distances = np.empty(0, np.int64), np.empty(0, np.int64)
        for r in range(WIDTH + 1):
            for s in range(SEGMENTS):
                value = own[s] ^ RINGS[r]
                low = self.bounds[s][value]
                found = ragged_take(self.order[s], low, self.bounds[s][value + 1] - low, np.arange(len(value)))
                found = found[~met[found]]
                met[found] = True
                entries = np.concatenate([entries, found])
                distances = np.concatenate([distances, np.bitwise_count(self.codes[found] ^ query).astype(np.int64)])
            if enough(entries, distances, SEGMENTS * (r + 1) - 1) or len(entries) == len(self.codes):
                break
        return entries, distances


def nearest_codes(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` nearest rows of every query: query_id, rank (from 1), id,
    distance; nearest first, ties to the smaller id, the query's own id left
    out (all others, if fewer than k).

    ``rows`` and ``queries`` have the columns id and code (long). Null ids and
    codes take no part; rows that repeat an id and code count once; an id with
    several codes counts with the nearest; an empty side gives an empty result.
    """
    prepare(rows.sparkSession)
    rows = rows.where("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct()
    keep = Window.partitionBy("code").orderBy("id")
    best = rows.withColumn("n", F.row_number().over(keep)).where(F.col("n") <= k + 1)
    entries = stored(best.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")  # at most k + 1 ids each
    asked = stored(queries.where("id IS NOT NULL AND code IS NOT NULL").select(F.col("id").alias("query_id"), F.col("code").alias("query_code")).distinct(), "queries")
    shards = -(-entries.count() // SHARD_CODES)
    slices = max(1, -(-asked.count() // SLICE_QUERIES))
    # each shard answers each slice of the stated queries
    sharded = (entries.withColumn("shard", F.pmod(F.xxhash64("code"), F.lit(max(1, shards))))
               .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))))
    dealt = (asked.withColumn("slice", F.pmod(F.xxhash64("query_id", "query_code"), F.lit(slices)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, shards - 1)).cast("long")))))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        lists = one_array(left.column("ids"))
        ids, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
        ends = ends - ends[0]
        codes = one_array(left.column("code")).to_numpy().view(np.uint64) if left.num_rows else np.empty(0, np.uint64)
        index, count = SegmentIndex(codes), np.diff(ends)
        out: list[list[np.ndarray]] = [[], [], []]
        for q, c in zip(one_array(right.column("query_id")).to_pylist(), one_array(right.column("query_code")).to_numpy().view(np.uint64) if right.num_rows else []):
            def enough(entries, distances, covered):
                # one id may be the query's own
                return count[entries[distances <= covered]].sum() > k
            found, distance = index.search(c, enough)
            if len(found) > k + 1:
                last = np.partition(distance, k)[k]
                near = distance <= last
                found, distance = found[near], distance[near]
            which = ragged_take(ids, ends[:-1], count, found)
            far = np.repeat(distance, count[found])
            other = which != q
            which, far = which[other], far[other]
            order = np.lexsort((which, far))[:k]
            out[0].append(np.full(len(order), q))
            out[1].append(which[order])
            out[2].append(far[order])
        joined = [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]
        return pa.table({"query_id": pa.array(joined[0], pa.int64()), "id": pa.array(joined[1], pa.int64()), "distance": pa.array(joined[2], pa.int32())})

    part = sharded.groupBy("shard", "slice").cogroup(dealt.groupBy("shard", "slice")).applyInArrow(answer, "query_id long, id long, distance int")
    part = part.groupBy("query_id", "id").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    return part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")
