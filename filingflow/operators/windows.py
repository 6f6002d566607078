"""Window-like operators (W2-W7) and ordered numbering.

Global numbering avoids the single-partition window Spark would plan for
``row_number() over (order by ...)``: rows are range-partitioned on the
order key, numbered inside each partition, and shifted by the row counts of
the partitions before them (one number per partition).
Per-key "latest row" picks use ``max_by`` aggregates, which combine partial
results map-side, so a hot key does not land in one task as a whole.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint


def global_row_number(df: DataFrame, order_cols: list[str], name: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """1-based row number in ``order_cols`` order (ties must be broken by the
    caller for a deterministic result). The intermediate is checkpointed to
    the shared checkpoint folder, so the count job and the numbering job see
    the same rows even after an executor loss."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(max(1, n), *[F.col(c).asc_nulls_first() for c in order_cols])
                .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order_cols])
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = reliable_checkpoint(ranged)
    # one row per partition reaches the driver; the shift of each partition goes
    # back as a literal, so consumers read the checkpoint and nothing else
    counts = {r["_pid"]: (r["_n"], r["_first"]) for r in
              ranged.groupBy("_pid").agg(F.count("*").alias("_n"), F.min("_mid").alias("_first")).collect()}
    shifts, before = [], 0
    for pid in range(max(counts, default=-1) + 1):
        rows, first = counts.get(pid, (0, 0))
        shifts.append(before - first + 1)
        before += rows
    shift = F.get(F.array(*[F.lit(x).cast("bigint") for x in shifts or [0]]), F.col("_pid"))
    return ranged.withColumn(name, (F.col("_mid") + shift).cast("bigint")).drop("_pid", "_mid")


def latest_per_key(df: DataFrame, key_cols: list[str], order_cols: list[str]) -> DataFrame:
    """The last row per key by ``order_cols`` (last write wins)."""
    payload = [c for c in df.columns if c not in key_cols]
    order = F.struct(*[F.col(c) for c in order_cols])
    picked = df.groupBy(*key_cols).agg(F.max_by(F.struct(*payload), order).alias("_r"))
    return picked.select(*key_cols, *[F.col("_r")[c].alias(c) for c in payload])


def latest_row(df: DataFrame, order_col: str) -> DataFrame:
    """The row with the largest ``order_col`` (one row, or none)."""
    payload = df.columns
    picked = df.agg(F.max_by(F.struct(*payload), F.col(order_col)).alias("_r"))
    return picked.filter(F.col("_r").isNotNull()).select(*[F.col("_r")[c].alias(c) for c in payload])


def chunk_batches(numbered: DataFrame, rn_col: str, total: int, workers: int,
                  min_size: int = 20) -> DataFrame:
    """Batch id of each row for batches of max(min_size, total // workers)."""
    size = max(min_size, total // max(1, workers))
    return numbered.withColumn("batch_id", F.floor((F.col(rn_col) - 1) / F.lit(size)).cast("bigint")) \
                   .withColumn("batch_size", F.lit(size))


def page_of(rn: Column, per_page: int = 20) -> Column:
    """1-based page of a 1-based row number."""
    return (F.floor((rn - 1) / F.lit(per_page)) + 1).cast("bigint")


def group_row_number(df: DataFrame, group_cols: list[str], order_cols: list[str],
                     name: str = "rn") -> DataFrame:
    """1-based row number inside each group without a per-group window: a
    global numbering over (group, order) -- range-partitioned, so one large
    group is spread over many tasks -- minus the group's first number (a
    partial aggregate, joined back on the group key)."""
    numbered = global_row_number(df, group_cols + order_cols, "_g")
    starts = numbered.groupBy(*group_cols).agg(F.min("_g").alias("_g0"))
    return (numbered.join(starts, group_cols)
                    .withColumn(name, (F.col("_g") - F.col("_g0") + 1).cast("bigint"))
                    .drop("_g", "_g0"))


def _same_as_before(columns: list[pa.Array], before: list) -> np.ndarray:
    """Whether each row has the values (nulls alike) of the row before it;
    ``before`` holds the values of the row before the first one."""
    n = len(columns[0])
    same = np.ones(n, bool)
    for column, last in zip(columns, before):
        shifted = pa.concat_arrays([pa.array([last], column.type), column.slice(0, n - 1)])
        equal = pc.fill_null(pc.equal(column, shifted), False).to_numpy(zero_copy_only=False)
        same &= equal | (column.is_null().to_numpy(zero_copy_only=False) & shifted.is_null().to_numpy(zero_copy_only=False))
    return same


def _miss_runs(batches, n_cycle: int, carry: int, same_as_carried: bool):
    """For each batch of a partition, ordered by cycle and place: (batch, first
    row of a cycle or after a non-miss?, misses in a row up to each row). The
    first row goes on with ``carry`` misses if its cycle is the carried one."""
    before, running, first = None, carry, True
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i) for i in range(n_cycle)]
        same = _same_as_before(columns, before) if before is not None else np.concatenate([[False], _same_as_before(
            [c.slice(1) for c in columns], [c[0].as_py() for c in columns])]) if batch.num_rows > 1 else np.array([False])
        if first:
            same[0] = same_as_carried
            first = False
        miss = pc.fill_null(pc.equal(batch.column(n_cycle), False), False).to_numpy(zero_copy_only=False)
        # a run goes on from the last row that is no miss or begins a cycle
        at = np.arange(batch.num_rows)
        base = np.where(~miss, at, np.where(~same, at - 1, -1 - running))
        base = np.maximum.accumulate(base)
        count = np.where(miss, at - base, 0)
        yield batch, same, count
        running = int(count[-1])
        before = [c[batch.num_rows - 1].as_py() for c in columns]


def miss_streak_cut(df: DataFrame, cycle_cols: list[str], order_col: str, hit_col: str,
                    streak: int = 3) -> DataFrame:
    """Within each cycle (ordered by ``order_col``), stop at the row that
    completes ``streak`` misses in a row; keep the hits before it.

    No per-cycle window and no self-join: rows are range-partitioned in
    (cycle, order), so a hot cycle is split over tasks, and each partition is
    scanned twice. The first scan reports its leading and trailing runs of
    misses; the driver links them (one row per partition) and gives every
    partition the run that it goes on with; the second scan finds the rows that
    complete a streak, of which the first per cycle is a partial aggregate."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_first() for c in [*cycle_cols, order_col]]
    ranged = reliable_checkpoint(df.repartitionByRange(max(1, n), *order).sortWithinPartitions(*order))
    k = len(cycle_cols)
    narrow = ranged.select(*cycle_cols, F.col(hit_col).alias("_hit"), F.col(order_col).alias("_order"),
                           F.to_json(F.struct(*cycle_cols)).alias("_cycle"), F.spark_partition_id().alias("_pid"))

    def report(batches):
        out, rows = None, 0
        for batch, same, count in _miss_runs(batches, k, 0, False):
            cycle, pid = batch.column(k + 2), batch.column(k + 3)[0].as_py()
            if out is None:
                out = {"pid": pid, "first": cycle[0].as_py(), "whole": True}
                same = np.concatenate([[True], same[1:]])
            rows += batch.num_rows
            # one unbroken run of one cycle goes on with what the partition before it brings
            out["whole"] = out["whole"] and bool(same.all()) and int(count[-1]) == rows
            out["last"], out["trail"] = cycle[batch.num_rows - 1].as_py(), int(count[-1])
        if out is not None:
            yield pa.RecordBatch.from_pylist([out], schema=pa.schema([("pid", pa.int32()), ("first", pa.string()), ("whole", pa.bool_()),
                                                                      ("last", pa.string()), ("trail", pa.int64())]))

    carry: dict[int, int] = {}
    last, trail = None, 0
    for r in sorted(narrow.mapInArrow(report, "pid int, first string, whole boolean, last string, trail long").collect(), key=lambda r: r["pid"]):
        goes_on = last is not None and r["first"] == last
        carry[r["pid"]] = trail if goes_on else -1
        trail = r["trail"] + (trail if r["whole"] and goes_on else 0)
        last = r["last"]

    names = [f"c{i}" for i in range(k)]

    def ends(batches):
        batches = iter(batches)
        head = next((b for b in batches if b.num_rows), None)
        if head is None:
            return
        brought = carry[head.column(k + 3)[0].as_py()]
        for batch, _, count in _miss_runs(chain([head], batches), k, max(brought, 0), brought >= 0):
            done = pa.array(count == streak)
            if pc.any(done).as_py():
                kept = batch.filter(done)
                yield pa.RecordBatch.from_arrays([*[kept.column(i) for i in range(k)], kept.column(k + 1)], names=[*names, "_order"])

    types = [*[narrow.schema[c].dataType for c in cycle_cols], narrow.schema["_order"].dataType]
    schema = T.StructType([T.StructField(c, t) for c, t in zip([*names, "_order"], types)])
    stops = narrow.mapInArrow(ends, schema).groupBy(*names).agg(F.min("_order").alias("_stop"))
    stops = stops.select(*[F.col(c).alias(of) for c, of in zip(names, cycle_cols)], "_stop")
    kept = ranged.filter(F.col(hit_col)).join(stops, cycle_cols, "left")
    return kept.filter(F.col("_stop").isNull() | (F.col(order_col) < F.col("_stop"))).drop("_stop")
