"""Aggregations (A1-A14) and the health rules built on them.

All aggregates are global or per group with partial (map-side) aggregation.
Two one-row results are put side by side with a join on a constant, which
Spark plans as a nested loop over one row each.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .._col import ntz_lit
from ..functions.dates import age_hours
from ..functions.text import COUNTRY, SOURCE_NAME, strip_ws, truthy

# Health thresholds and exit codes.
STALE_HOURS = 48
EXIT_CODES = {"ok": 0, "degraded": 0, "stale": 1, "empty": 2, "error": 3}
SCRAPER_NAME = "mexico-scraper"


def _ts(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        return ntz_lit(as_of).cast("timestamp")
    return F.lit(str(as_of)).cast("timestamp")


def health_of(last_id: Column, completed_at: Column, errors: Column, as_of) -> Column:
    """empty (no run) > error (never completed) > stale (> 48 h) >
    degraded (non-blank errors) > ok."""
    age = age_hours(completed_at, _ts(as_of))
    return (F.when(last_id.isNull(), F.lit("empty"))
             .when(completed_at.isNull(), F.lit("error"))
             .when(age > STALE_HOURS, F.lit("stale"))
             .when(strip_ws(F.coalesce(errors, F.lit(""))) != "", F.lit("degraded"))
             .otherwise(F.lit("ok")))


def exit_code(health: Column) -> Column:
    """health -> process exit code."""
    m = F.create_map(*[x for k, v in EXIT_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[health], F.lit(3))


def health_per_group(groups: DataFrame, log: DataFrame, group_col: str, as_of) -> DataFrame:
    """Health of the latest run (max id, W3) of each group; groups with no
    run are 'empty'. ``max_by`` combines map-side, so one busy group does
    not go to one task whole."""
    last = (log.groupBy(group_col)
               .agg(F.max_by(F.struct("id", "completed_at", "errors"), "id").alias("r")))
    j = groups.join(last, group_col, "left")
    h = health_of(F.col("r.id"), F.col("r.completed_at"), F.col("r.errors"), as_of)
    return j.select(group_col, F.col("r.id").alias("last_run_id"), h.alias("health")) \
            .withColumn("exit_code", exit_code(F.col("health")))


def filings_counters(filings: DataFrame) -> DataFrame:
    """A1, A3, A4, A5, A7 in one aggregate."""
    t = F.col("ticker")
    return filings.agg(
        F.count("*").alias("total_filings"),
        F.count_if(F.coalesce(F.col("downloaded"), F.lit(False))).alias("downloaded"),
        F.count_distinct(F.when(t.isNotNull() & (t != ""), t)).alias("unique_companies"),
        F.min("filing_date").alias("earliest_record"),
        F.max("filing_date").alias("latest_record"),
    ).withColumn("pending_download", F.col("total_filings") - F.col("downloaded"))


def stats_record(filings: DataFrame, log: DataFrame, as_of, db_size_bytes: int = 0,
                 documents_size_bytes: int = 0) -> DataFrame:
    """The one-row stats record."""
    f = filings_counters(filings).withColumn("_k", F.lit(1))
    g = log.agg(F.count("completed_at").alias("total_crawl_runs"),
                F.max_by(F.struct("id", "completed_at", "errors"), "id").alias("r")).withColumn("_k", F.lit(1))
    j = f.join(F.broadcast(g), "_k")  # both sides are one row
    return j.select(
        F.lit(SCRAPER_NAME).alias("scraper"), F.lit(COUNTRY).alias("country"),
        F.array(F.lit(SOURCE_NAME)).alias("sources"),
        "total_filings", "downloaded", "pending_download", "unique_companies", "total_crawl_runs",
        "earliest_record", "latest_record",
        F.lit(db_size_bytes).cast("bigint").alias("db_size_bytes"),
        F.lit(documents_size_bytes).cast("bigint").alias("documents_size_bytes"),
        health_of(F.col("r.id"), F.col("r.completed_at"), F.col("r.errors"), as_of).alias("health"))


def run_tally_columns(batch: DataFrame) -> list[Column]:
    """Found (duplicates included) and downloaded documents, and
    whether downloads are on."""
    enabled = F.coalesce(F.first("downloads_enabled"), F.lit(False)) \
        if "downloads_enabled" in batch.columns else F.lit(False)
    return [F.count("*").alias("filings_found"), F.count_if(truthy(F.col("pdf_path"))).alias("pdfs_downloaded"),
            enabled.alias("_on")]


def with_failed_downloads(tallies: DataFrame, max_pages: int | None) -> DataFrame:
    """Failed documents (0 when downloads are off) and requested pages."""
    return (tallies.withColumn("pages_crawled", F.lit(max(1, max_pages or 1)))
                   .withColumn("pdfs_failed", F.when(F.col("_on"), F.col("filings_found") - F.col("pdfs_downloaded"))
                               .otherwise(F.lit(0)).cast("bigint")).drop("_on"))


def run_tallies(batch: DataFrame, max_pages: int | None) -> DataFrame:
    """A9/A10 of one run."""
    return with_failed_downloads(batch.agg(*run_tally_columns(batch)), max_pages).select(
        "filings_found", "pages_crawled", "pdfs_downloaded", "pdfs_failed")


def resolve_tally_columns() -> list[Column]:
    """Resolved and failed keys."""
    return [F.count_if(F.col("enc").isNotNull()).alias("resolved"), F.count_if(F.col("enc").isNull()).alias("failed")]


def resolve_rate(done: int, total: int, seconds: float) -> tuple[float, float]:
    """(keys per second, seconds left) of a build that has handled
    ``done`` of ``total`` keys in ``seconds``."""
    rate = done / seconds if seconds > 0 else 0.0
    return rate, (total - done) / rate if rate > 0 else 0.0


def max_key_column(key_col: str = "key") -> Column:
    """Largest integer key, 0 when there is none."""
    return F.coalesce(F.max(F.col(key_col).try_cast("bigint")), F.lit(0)).cast("bigint").alias("max_key")


def max_key(rows: DataFrame, key_col: str = "key") -> DataFrame:
    return rows.agg(max_key_column(key_col))
