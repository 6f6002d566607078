"""E4 stats: one record of counters, sizes and health, plus its text form."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import EXIT_CODES, SCRAPER_NAME, stats_record
from ..operators.store import CRAWL_LOG_SCHEMA, FILINGS_SCHEMA
from ..operators.tables import read_table
from ..sources.files import dir_size

log = logging.getLogger(__name__)

STATS_FIELDS = ["scraper", "country", "sources", "total_filings", "downloaded", "pending_download",
                "unique_companies", "total_crawl_runs", "earliest_record", "latest_record",
                "db_size_bytes", "documents_size_bytes", "health"]


def compute_stats(spark: SparkSession, filings_dir: str, log: DataFrame | str, docs_dir: str,
                  as_of: dt.datetime) -> dict:
    """A13 with S10/S11 sizes; any failure gives the zeroed record with
    health 'error'. Returns a plain dict (one row)."""
    try:
        filings = read_table(spark, filings_dir, FILINGS_SCHEMA)
        log_df = read_table(spark, log, CRAWL_LOG_SCHEMA) if isinstance(log, str) else log
        db = dir_size(spark, filings_dir).first()["total_bytes"]
        docs = dir_size(spark, docs_dir).first()["total_bytes"]
        row = stats_record(filings, log_df, as_of, db, docs).first().asDict(recursive=True)
        return {k: row[k] for k in STATS_FIELDS}
    except Exception as e:  # noqa: BLE001 - stats never fail, they report 'error'
        log.warning("statistics failed: %s", e)
        return {"scraper": SCRAPER_NAME, "country": "MX", "sources": ["cnbv"], "total_filings": 0,
                "downloaded": 0, "pending_download": 0, "unique_companies": 0, "total_crawl_runs": 0,
                "earliest_record": None, "latest_record": None, "db_size_bytes": 0,
                "documents_size_bytes": 0, "health": "error"}


def stats_text(s: dict) -> str:
    """Human-readable form of the stats record."""
    rows = [("Total filings", s["total_filings"]), ("Downloaded", s["downloaded"]),
            ("Pending download", s["pending_download"]), ("Unique companies", s["unique_companies"]),
            ("Crawl runs", s["total_crawl_runs"]),
            ("Date range", f"{s['earliest_record'] or '-'} .. {s['latest_record'] or '-'}"),
            ("Table size (bytes)", s["db_size_bytes"]), ("Documents size (bytes)", s["documents_size_bytes"]),
            ("Health", s["health"])]
    width = max(len(k) for k, _ in rows)
    return "\n".join(f"{k:<{width}}  {v}" for k, v in rows)


def exit_code_of(health: str) -> int:
    """F24 on the driver for the process exit status."""
    return EXIT_CODES.get(health, 3)


def stats_frame(spark: SparkSession, s: dict) -> DataFrame:
    return spark.createDataFrame([tuple(s[k] for k in STATS_FIELDS)],
                                 ", ".join(f"{k} {t}" for k, t in zip(STATS_FIELDS, [
                                     "string", "string", "array<string>", "bigint", "bigint", "bigint",
                                     "bigint", "bigint", "string", "string", "bigint", "bigint", "string"]))) \
                .select(*STATS_FIELDS).withColumn("exit_code", F.lit(exit_code_of(s["health"])))
