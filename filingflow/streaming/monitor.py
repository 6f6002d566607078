"""Structured Streaming monitor.

The source system polls a portal for keys above a high-water mark. Here new
filings arrive as files in a landing folder; a streaming query reads them,
keeps keys above the baseline however late they come, and a ``foreachBatch``
sink writes the rows of new keys to ``sink/batch_id=N`` with overwrite, so a
replayed batch after a failure rewrites the same folder (exactly-once with the
checkpoint). ``cycles`` says which keys are new, and keeps the counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import SOURCE_NAME
from ..sources.documents import _exists
from .cycles import fresh_keys, record_cycle


def write_drop(df: DataFrame, landing: str) -> None:
    """Test feed: one drop of rows into the landing folder, as many files as
    the rows have partitions."""
    df.write.mode("append").parquet(landing)


def time_slices(df: DataFrame, drops: int, ts_col: str) -> list[DataFrame]:
    """The rows cut into ``drops`` event-time slices. Slices are cut on epoch
    microseconds, so no time zone enters."""
    m = F.unix_micros(F.col(ts_col).cast("timestamp"))
    lo, hi = df.agg(F.min(m), F.max(m)).first()
    if lo is None:
        return []
    span, out = (hi - lo) / drops, []
    for i in range(drops):
        cond = m >= F.lit(int(lo + span * i)) if i else F.lit(True)
        if i < drops - 1:
            cond = cond & (m < F.lit(int(lo + span * (i + 1))))
        out.append(df.filter(cond))
    return out


@dataclass
class MonitorPaths:
    landing: str
    sink: str
    state: str
    checkpoint: str


def sink_rows(batch: DataFrame, batch_id: int, paths: MonitorPaths, by_source: bool) -> None:
    """Rows of the batch's new keys, one per key, and the batch's cycle."""
    batch = batch.dropDuplicates(["source", "key"]).persist()
    try:
        fresh = fresh_keys(batch.sparkSession, paths.state, batch, batch_id)
        new = batch.join(fresh.select("source", "key"), ["source", "key"], "left_semi")
        (new if by_source else new.drop("source")).write.mode("overwrite").parquet(f"{paths.sink}/batch_id={batch_id}")
        record_cycle(batch, fresh, paths.state, batch_id, by_source)
    finally:
        batch.unpersist()


def run_monitor(spark: SparkSession, paths: MonitorPaths, schema: T.StructType, baseline: int,
                key_col: str = "key", ts_col: str = "ts", max_files: int | None = None, source_col: str | None = None) -> None:
    """Work off the files in the landing folder that no earlier run
    has seen (``availableNow``). ``max_files`` splits a backlog into batches.
    Keys are per source where ``source_col`` names one."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(paths.landing)
    keyed = (stream.withColumn("key", F.col(key_col).cast("bigint"))
                   .withColumn("ts", F.col(ts_col).cast("timestamp"))
                   .withColumn("source", F.coalesce(F.col(source_col).cast("string"), F.lit("")) if source_col else F.lit(SOURCE_NAME))
                   .filter(F.col("key") > F.lit(baseline)))
    q = (keyed.writeStream.foreachBatch(lambda batch, batch_id: sink_rows(batch, batch_id, paths, source_col is not None))
              .option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


# ---------------------------------------------------------------------------
# Events per day
# ---------------------------------------------------------------------------

#: days that event times may lie behind the newest one before their day is closed
DELAY_DAYS = 1
_DAY_MICROS = 86_400_000_000
_DAY_ROWS = "batch_id long, start timestamp, day string, n long, last_ts timestamp"


def split_days(batch: DataFrame, batch_id: int, out: str, ts_col: str) -> None:
    """Per-day counts of a batch, those of days that the watermark (the newest
    event time of earlier batches less the delay) has closed apart."""
    spark = batch.sparkSession
    seen = [spark.read.schema(_DAY_ROWS).parquet(f"{out}/{part}") for part in ("on_time", "corrections") if _exists(spark, f"{out}/{part}")]
    newest = None
    for rows in seen:
        m = rows.filter(F.col("batch_id") < batch_id).agg(F.max(F.unix_micros("last_ts"))).first()[0]
        newest = m if newest is None or m is not None and m > newest else newest
    ts = F.col(ts_col).cast("timestamp")
    start = F.date_trunc("day", ts)
    days = batch.filter(ts.isNotNull()).groupBy(start.alias("start")).agg(F.count("*").alias("n"), F.max(ts).alias("last_ts"))
    late = F.lit(False) if newest is None else F.unix_micros("start") + _DAY_MICROS <= F.lit(newest - DELAY_DAYS * _DAY_MICROS)
    rows = days.select(F.lit(batch_id).cast("long").alias("batch_id"), "start", F.date_format("start", "yyyy-MM-dd").alias("day"), "n", "last_ts",
                       late.alias("late")).persist()
    try:
        # appended for the next stream, which takes a repeated batch once
        rows.filter(~F.col("late")).drop("late").coalesce(1).write.mode("append").parquet(f"{out}/on_time")
        rows.filter("late").drop("late").coalesce(1).write.mode("append").parquet(f"{out}/corrections")
    finally:
        rows.unpersist()


def close_days(spark: SparkSession, out: str) -> None:
    """Windows of a day in append mode: a day is written once, when the
    watermark has passed its end. No row comes later than the watermark: such
    rows went to the corrections."""
    on_time = spark.readStream.schema(_DAY_ROWS).parquet(f"{out}/on_time").withWatermark("last_ts", f"{DELAY_DAYS} days")
    days = (on_time.dropDuplicatesWithinWatermark(["batch_id", "day"]).groupBy(F.window("last_ts", "1 day"))
                   .agg(F.sum("n").alias("n")).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "n"))
    (days.writeStream.format("parquet").option("path", f"{out}/closed").option("checkpointLocation", f"{out}/close")
         .outputMode("append").trigger(availableNow=True).start().awaitTermination())


def daily_counts(spark: SparkSession, out: str) -> DataFrame:
    """Day, events (closed or open windows, and corrections), late events, and
    whether the day is closed."""
    def rows(part: str) -> DataFrame:
        there = _exists(spark, f"{out}/{part}")
        return (spark.read.schema(_DAY_ROWS).parquet(f"{out}/{part}") if there else spark.createDataFrame([], _DAY_ROWS)).dropDuplicates(["batch_id", "day"])

    closed = spark.read.schema("day string, n long").parquet(f"{out}/closed") if _exists(spark, f"{out}/closed") else spark.createDataFrame([], "day string, n long")
    open_ = rows("on_time").join(closed.select("day"), "day", "left_anti")
    zero = F.lit(0).cast("long")
    parts = (closed.select("day", "n", zero.alias("late"), F.lit(True).alias("closed"))
             .unionByName(open_.select("day", "n", zero.alias("late"), F.lit(False).alias("closed")))
             .unionByName(rows("corrections").select("day", "n", F.col("n").alias("late"), F.lit(True).alias("closed"))))
    return parts.groupBy("day").agg(F.sum("n").alias("n_events"), F.sum("late").alias("n_late"), F.bool_or("closed").alias("closed"))


def run_daily_counts(spark: SparkSession, landing: str, out: str, checkpoint: str, schema: T.StructType,
                     ts_col: str = "ts", max_files: int | None = None) -> DataFrame:
    """Events per day of what has landed. Days close behind the watermark;
    rows of closed days go to a correction stream, so none is lost."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    q = (reader.parquet(landing).writeStream.foreachBatch(lambda batch, batch_id: split_days(batch, batch_id, out, ts_col))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if _exists(spark, f"{out}/on_time"):
        close_days(spark, out)
    return daily_counts(spark, out)
