"""Poll cycles per source: new keys, high-water marks, burst fold, pacing.

Each micro-batch of a monitor is a cycle of every source that it has rows of.
Under the monitor's state folder:

* ``keys``   every key seen, with the batch that brought it (a stored keyed
  table). A key is new to a batch if no other batch brought it, so a replayed
  batch counts what it counted before;
* ``cycles`` one row per source and batch: new keys and the largest key. Rows
  are appended; a replay appends the same row again;
* ``bursts`` the look-ahead fold: a streaming query over ``cycles`` that keeps
  (last batch, largest key, look-ahead) per source as keyed state and takes
  every batch once. It sees one row per source and batch, however many keys a
  source has, so a source with most of the rows is no hot group.

``watch`` polls: again at once after a burst, else after the interval.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.text import SOURCE_NAME
from ..operators.tables import probe, upsert_table
from ..session import stored
from ..sources.documents import _exists

# Adaptive look-ahead and poll interval of the monitor.
LOOK_AHEAD_START = 5
LOOK_AHEAD_MAX = 200
POLL_SECONDS = 300

KEYS_SCHEMA = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("source", T.StringType()),
                            T.StructField("key", T.LongType()), T.StructField("batch", T.LongType())])
CYCLES_SCHEMA = "source string, batch_id long, new_count long, last_key long, idle boolean"
BURSTS_SCHEMA = "source string, batch_id long, new_count long, last_key long, look_ahead int, mode string"
#: state partitions of the fold: it holds one row per source
FOLD_PARTITIONS = 4


def next_look_ahead(look_ahead: int, new_count: int) -> tuple[int, str]:
    """Double (up to 200) when a cycle found at least look_ahead - 2 new
    keys; otherwise back to 5."""
    if new_count > 0 and new_count >= look_ahead - 2:
        return min(look_ahead * 2, LOOK_AHEAD_MAX), "burst"
    return LOOK_AHEAD_START, ("normal" if new_count > 0 else "idle")


def fresh_keys(spark: SparkSession, state: str, batch: DataFrame, batch_id: int) -> DataFrame:
    """(id, source, key) of the keys that no other batch brought, recorded as
    this batch's. ``batch`` has source and key; only the buckets of its keys
    are read, however old the keys are."""
    ids = (batch.select(F.coalesce("source", F.lit("")).alias("source"), "key").distinct()
                .select(F.concat_ws("\x1f", "source", F.col("key").cast("string")).alias("id"), "source", "key"))
    others = probe(spark, f"{state}/keys", KEYS_SCHEMA, ids).filter(F.col("batch") != batch_id)
    fresh = stored(ids.join(others.select("id"), "id", "left_anti"), "fresh-keys")
    upsert_table(spark, f"{state}/keys", KEYS_SCHEMA, fresh.withColumn("batch", F.lit(batch_id).cast("long"))
                 .withColumn("_seq", F.lit(batch_id)).withColumn("_pos", F.col("key")), ["id"])
    return fresh


def record_cycle(batch: DataFrame, fresh: DataFrame, state: str, batch_id: int, by_source: bool) -> None:
    """Append a row per source of the batch; without a source column there is
    one source, which has a row for an empty batch too."""
    counts = fresh.select("source", F.lit(1).alias("new"), F.col("key").alias("last")).unionByName(
        batch.select(F.coalesce("source", F.lit("")).alias("source"), F.lit(0).alias("new"), F.lit(None).cast("long").alias("last")))
    aggs = [F.coalesce(F.sum("new"), F.lit(0)).alias("new_count"), F.max("last").alias("last_key")]
    rows = counts.groupBy("source").agg(*aggs) if by_source else counts.agg(*aggs).withColumn("source", F.lit(SOURCE_NAME))
    (rows.select("source", F.lit(batch_id).cast("long").alias("batch_id"), "new_count", "last_key", F.lit(False).alias("idle"))
         .coalesce(1).write.mode("append").parquet(f"{state}/cycles"))


def cycles_of(spark: SparkSession, state: str) -> DataFrame:
    """One row per source and batch."""
    if not _exists(spark, f"{state}/cycles"):
        return spark.createDataFrame([], CYCLES_SCHEMA)
    return spark.read.schema(CYCLES_SCHEMA).parquet(f"{state}/cycles").filter(~F.col("idle")).dropDuplicates(["source", "batch_id"])


def stored_last_key(spark: SparkSession, state: str, source: str | None = None) -> int:
    """High-water mark of the state (of a source); 0 when absent."""
    rows = cycles_of(spark, state)
    rows = rows if source is None else rows.filter(F.col("source") == source)
    return int(rows.agg(F.max("last_key")).first()[0] or 0)


def baseline_key(spark: SparkSession, state: str, cached_keys: DataFrame | None, start_key: int | None = None) -> int:
    """max(stored state or the given start key, max cached key)."""
    stored = start_key if start_key is not None else stored_last_key(spark, state)
    cached = 0
    if cached_keys is not None:
        cached = int(cached_keys.agg(F.max(F.col("key").cast("bigint"))).first()[0] or 0)
    return max(stored, cached)


class BurstFold(StatefulProcessor):
    """Keyed state of a source: last batch, largest key, look-ahead."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("source", "batch_id long, last_key long, look_ahead int")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803 - the interface's names
        cycles = pd.concat(list(rows)).sort_values(["batch_id", "idle"])
        batch, last, ahead = self.state.get() if self.state.exists() else (-1, 0, LOOK_AHEAD_START)
        out = []
        for c in cycles.itertuples():
            if c.batch_id < batch or c.batch_id == batch and not c.idle:
                continue  # a replayed batch: it has been folded
            new = 0 if c.idle else int(c.new_count)
            ahead, mode = next_look_ahead(ahead, new)
            last = max(last, 0 if pd.isna(c.last_key) else int(c.last_key))
            batch = int(c.batch_id)
            out.append((key[0], batch, new, last, ahead, mode))
        self.state.update((batch, last, ahead))
        yield pd.DataFrame(out, columns=["source", "batch_id", "new_count", "last_key", "look_ahead", "mode"])

    def close(self) -> None:
        pass


def fold_cycles(spark: SparkSession, state: str) -> None:
    """Fold the cycles recorded since the last fold, source by source."""
    if not _exists(spark, f"{state}/cycles"):
        return
    wanted = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
              "spark.sql.shuffle.partitions": str(FOLD_PARTITIONS)}
    was = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        folded = (spark.readStream.schema(CYCLES_SCHEMA).parquet(f"{state}/cycles").groupBy("source")
                       .transformWithStateInPandas(BurstFold(), BURSTS_SCHEMA, "Append", "None"))
        (folded.writeStream.format("parquet").option("path", f"{state}/bursts").option("checkpointLocation", f"{state}/fold")
               .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    finally:
        for k, v in was.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def burst_log(spark: SparkSession, state: str) -> DataFrame:
    """The look-ahead fold, one row per source and batch."""
    if not _exists(spark, f"{state}/bursts"):
        return spark.createDataFrame([], BURSTS_SCHEMA)
    return spark.read.schema(BURSTS_SCHEMA).parquet(f"{state}/bursts")


def poll(spark: SparkSession, state: str, run: Callable[[], None]) -> str:
    """One poll: ``run`` works off what has landed, the fold follows. The mode
    of the busiest source: burst, normal or idle. A poll without rows is an
    idle cycle of every source, which ends its burst."""
    def newest() -> int:
        return cycles_of(spark, state).agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]

    before = newest()
    run()
    if newest() == before:
        idle = cycles_of(spark, state).groupBy("source").agg(F.max("batch_id").alias("batch_id"), F.max("last_key").alias("last_key"))
        (idle.select("source", "batch_id", F.lit(0).cast("long").alias("new_count"), "last_key", F.lit(True).alias("idle"))
             .coalesce(1).write.mode("append").parquet(f"{state}/cycles"))
        fold_cycles(spark, state)
        return "idle"
    fold_cycles(spark, state)
    last = (burst_log(spark, state).filter(F.col("batch_id") > before).groupBy("source").agg(F.max_by("mode", "batch_id").alias("mode")))
    modes = {r["mode"] for r in last.select("mode").distinct().collect()}
    return "burst" if "burst" in modes else "normal" if "normal" in modes else "idle"


def watch(once: Callable[[], str], interval: float = POLL_SECONDS, sleep: Callable[[float], None] = time.sleep,
          polls: int | None = None) -> int:
    """Poll for ever (or ``polls`` times). After a burst the next poll
    follows at once, otherwise after ``interval`` seconds. An interrupt ends
    the watch; the state is in the tables. The number of polls."""
    done = 0
    try:
        while polls is None or done < polls:
            mode = once()
            done += 1
            if mode != "burst" and (polls is None or done < polls):
                sleep(interval)
    except KeyboardInterrupt:
        pass
    return done
