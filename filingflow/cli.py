"""Command line (spark-submit entry point): crawl | monitor | export | stats |
cache | extract | isin | mark.

    spark-submit -m filingflow crawl --payloads P --filings D --log L --as-of 2026-01-01T00:00:00
    python -m filingflow stats --filings D --log L --docs DOCS --json

Tables are parquet folders partitioned by a hash bucket of their key; the crawl log is two append-only event tables (``starts``, ``completions``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import secrets
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.aggregates import resolve_rate, run_tallies
from .operators.joins import merge_download_status, new_ids
from .operators.store import FILING_RECORD_SCHEMA, FILINGS_SCHEMA, TOKEN_CACHE_SCHEMA, crawl_log, keep_downloads
from .operators.tables import FIRST_BUCKETS, probe, read_table, upsert_table
from .plans.crawl import GRID_KINDS, crawl_rows, download_results, parse_payloads, select_rows
from .session import get_spark, reliable_checkpoint
from .sources.documents import _exists, export_document, write_filings_document
from .sources.isin import read_cache
from .sources.payloads import read_payloads

START_SCHEMA = "id long, crawl_type string, query_params string, started_at string"
DONE_SCHEMA = ("id long, seq long, filings_found int, filings_new int, pages_crawled int, errors string, "
               "completed_ts timestamp")


def read_log(spark: SparkSession, log_dir: str) -> DataFrame:
    """Current crawl log from its event tables (empty when absent)."""
    starts = (spark.read.schema(START_SCHEMA).parquet(f"{log_dir}/starts")
              if _exists(spark, f"{log_dir}/starts") else spark.createDataFrame([], START_SCHEMA))
    done = (spark.read.schema(DONE_SCHEMA).parquet(f"{log_dir}/completions")
            if _exists(spark, f"{log_dir}/completions") else spark.createDataFrame([], DONE_SCHEMA))
    return crawl_log(starts, done)


def utc(text: str | None) -> dt.datetime:
    """An ISO time as an aware UTC time (without a zone it is UTC); now for None."""
    if text is None:
        return dt.datetime.now(dt.timezone.utc)
    t = dt.datetime.fromisoformat(text)
    return t.replace(tzinfo=dt.timezone.utc) if t.tzinfo is None else t.astimezone(dt.timezone.utc)


def utc_text(t: dt.datetime) -> str:
    """UTC wall time without a zone, as the tables hold it."""
    return t.replace(tzinfo=None).isoformat()


def log_start(spark: SparkSession, log_dir: str, crawl_type: str, params: dict, now: dt.datetime) -> int:
    """M4: append a start event. The id is the start in microseconds and twelve
    random bits, so it grows from run to run, and two runs that start in the
    same microsecond without seeing each other get two ids. An id that the log
    has (a given start time, used again) is not used again."""
    run_id = (int(now.timestamp() * 1e6) << 12) + secrets.randbelow(1 << 12)
    if _exists(spark, f"{log_dir}/starts"):
        same = spark.read.schema(START_SCHEMA).parquet(f"{log_dir}/starts").filter(F.col("id") >= run_id).agg(F.max("id")).first()[0]
        run_id = max(run_id, int(same or 0) + 1)
    q = json.dumps(params, ensure_ascii=False)  # a scalar, serialised on the driver
    spark.createDataFrame([(run_id, crawl_type, q, utc_text(now))], START_SCHEMA) \
         .write.mode("append").parquet(f"{log_dir}/starts")
    return run_id


def log_complete(spark: SparkSession, log_dir: str, run_id: int, found: int, new: int, pages: int,
                 errors: str | None, now: dt.datetime) -> None:
    """M5: append a completion event (the latest one per id counts)."""
    seq = int(now.timestamp() * 1e6)
    spark.createDataFrame([(run_id, seq, found, new, pages, errors, now)], DONE_SCHEMA) \
         .write.mode("append").parquet(f"{log_dir}/completions")


def cmd_crawl(spark: SparkSession, a: argparse.Namespace) -> int:
    started, clock = utc(a.as_of), time.monotonic()
    as_of = utc_text(started)

    def finished() -> dt.datetime:
        return started + dt.timedelta(seconds=time.monotonic() - clock)

    run_id = log_start(spark, a.log, "crawl", {"period": a.period, "max_pages": a.max_pages}, started)
    try:
        bronze = read_payloads(spark, a.payloads, GRID_KINDS)
        isin_map = read_cache(spark, a.isin_cache) if a.isin_cache else None
        # parse once; the selected rows feed the counts, the new-id check and the upsert
        rows = reliable_checkpoint(select_rows(parse_payloads(bronze), bronze, as_of, a.period, a.max_pages))
        if a.download_dir:
            files = read_payloads(spark, a.payloads, ["download", "detail"])
            rows = merge_download_status(rows, download_results(rows, files, a.download_dir))
        found = rows.count()
        if found == 0:
            log_complete(spark, a.log, run_id, 0, 0, 0, "No filings found", finished())
            return 1
        # batch order = (payload, position): a later row of the crawl wins
        batch = reliable_checkpoint(crawl_rows(rows, isin_map, as_of, batch_seq=run_id, keep_order=True))
        existing = probe(spark, a.filings, FILINGS_SCHEMA, batch)
        fresh = new_ids(batch, existing).count()
        tallies = run_tallies(batch.select(F.nullif("download_path", F.lit("")).alias("pdf_path"), F.lit(bool(a.download_dir)).alias("downloads_enabled")),
                              a.max_pages).first()
        upsert_table(spark, a.filings, FILINGS_SCHEMA, keep_downloads(existing, batch) if a.mode == "preserve" else batch, ["filing_id"], buckets=a.buckets)
        if a.json_out:
            record = F.from_json("raw_metadata", FILING_RECORD_SCHEMA)
            document = batch.select(record.alias("r"), "isin").select("r.*", "isin")
            write_filings_document(document, a.json_out, source="payloads", scraped_at=as_of,
                                   downloads_enabled=bool(a.download_dir), mode="overwrite")
        log_complete(spark, a.log, run_id, found, fresh, tallies["pages_crawled"], None, finished())
        return 0
    except Exception as exc:  # logged as completed with the error, then re-raised
        log_complete(spark, a.log, run_id, 0, 0, 0, str(exc), finished())
        raise


def cmd_stats(spark: SparkSession, a: argparse.Namespace) -> int:
    from .plans.stats import compute_stats, exit_code_of, stats_text
    as_of = utc(a.as_of).replace(tzinfo=None)
    s = compute_stats(spark, a.filings, read_log(spark, a.log), a.docs, as_of)
    print(json.dumps(s, ensure_ascii=False) if a.json else stats_text(s))
    return exit_code_of(s["health"])


def cmd_export(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = export_document(spark, a.src, a.dest)
    if rows is None:
        print(f"no filings document at {a.src}", file=sys.stderr)
    return 0


PAYLOAD_COLUMNS = {"payload_id", "kind", "body"}


def cmd_monitor(spark: SparkSession, a: argparse.Namespace) -> int:
    """Payloads in the landing folder become tokens and filings; a
    landing folder of plain keyed rows goes through the row monitor."""
    from .streaming.cycles import baseline_key, poll, watch
    from .streaming.filings import FilingsPaths, run_filings_monitor
    from .streaming.monitor import MonitorPaths, run_monitor
    state, tokens = f"{a.out}/state", a.cache or f"{a.out}/tokens"
    cached = read_table(spark, tokens, TOKEN_CACHE_SCHEMA).select("key")
    base = baseline_key(spark, state, cached, a.start_key)
    if base == 0 and not _exists(spark, state):
        # No state and no start key -> newest key of the first search
        first = read_payloads(spark, a.baseline_payloads) if a.baseline_payloads else None
        if first is None:
            print("no baseline: give --start-key or --baseline-payloads", file=sys.stderr)
            return 1
        from .operators.aggregates import max_key
        base = int(max_key(parse_payloads(first)).first()[0])
        if base == 0:
            print("no filings in the baseline search", file=sys.stderr)
            return 1
    schema = spark.read.parquet(a.landing).schema
    if PAYLOAD_COLUMNS <= set(schema.fieldNames()):
        paths = FilingsPaths(a.landing, a.filings or f"{a.out}/filings", tokens, state, f"{a.out}/checkpoint", a.json_out)

        def run() -> None:
            run_filings_monitor(spark, paths, base, utc_text(utc(a.as_of)), a.max_files)
    else:
        rows = MonitorPaths(a.landing, f"{a.out}/sink", state, f"{a.out}/checkpoint")

        def run() -> None:
            run_monitor(spark, rows, schema, base, a.key_col, a.ts_col, a.max_files, a.source_col)
    watch(lambda: poll(spark, state, run), a.interval, polls=1 if a.once else None)
    return 0


def cmd_isin(spark: SparkSession, a: argparse.Namespace) -> int:
    """The ISIN map from captured list pages, cached (S7); a cached map, or
    the source system's JSON object, is used unless --refresh is given."""
    from .plans.isin_build import isin_map_from_payloads
    from .sources.isin import load_isin_map
    built = load_isin_map(spark, a.cache, lambda: isin_map_from_payloads(read_payloads(spark, a.payloads)), a.refresh, a.json_cache)
    print(json.dumps({"entries": built.count(), "cache": a.cache}))
    return 0


def cmd_mark(spark: SparkSession, a: argparse.Namespace) -> int:
    """M3: mark filings as downloaded from a table of (filing_id,
    download_path, seq); the last path of a filing counts."""
    from .operators.tables import mark_downloaded_table
    updates = spark.read.schema("filing_id string, download_path string, seq long").parquet(a.updates)
    print(json.dumps({"marked": mark_downloaded_table(spark, a.filings, updates)}))
    return 0


def cmd_cache(spark: SparkSession, a: argparse.Namespace) -> int:
    from .operators.aggregates import max_key
    from .plans.cache_build import resolve_missing
    cache = read_table(spark, a.cache, TOKEN_CACHE_SCHEMA)
    payloads = (read_payloads(spark, a.payloads, ["token_callback"])
                .select(F.col("payload_id").try_cast("bigint").alias("key"), "body")
                .filter(F.col("key").isNotNull()))
    clock = time.monotonic()
    end = a.end
    if end == 0:
        # open end: up to the newest key of the newest search
        end = int(max_key(parse_payloads(read_payloads(spark, a.payloads, GRID_KINDS))).first()[0])
        if end == 0:
            print("no end: the payloads hold no keyed rows", file=sys.stderr)
            return 1
    fresh, tallies = resolve_missing(spark, cache, payloads, a.start, end, a.as_of)
    upsert_table(spark, a.cache, TOKEN_CACHE_SCHEMA, fresh, ["key"], buckets=a.buckets)
    out = tallies.first().asDict()
    rate, left = resolve_rate(out["resolved"] + out["failed"], out["to_resolve"], time.monotonic() - clock)
    print(json.dumps(out | {"rate_per_sec": round(rate, 3), "remaining_sec": round(left, 3)}))
    return 0


def cmd_extract(spark: SparkSession, a: argparse.Namespace) -> int:
    from .plans.extract import DEFAULT_MODEL, extract_single_file, process_filings
    from .sources.documents import read_filings_document, write_extracted
    from .sources.files import binary_files
    if a.file:
        out = extract_single_file(spark, a.file)
        print(json.dumps(out.first().asDict(recursive=True), ensure_ascii=False, default=str))
        return 0
    filings = read_filings_document(spark, a.filings)
    # binaryFile reports local files as file: URIs; filings record plain paths
    docs = binary_files(spark, a.documents).select(
        F.regexp_replace("path", r"^file:(?://)?", "").alias("source_file"), "content")
    write_extracted(process_filings(filings, docs).select("filing", "source_file", "extracted"),
                    a.out, DEFAULT_MODEL)
    return 0


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="filingflow")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("crawl")
    c.add_argument("--payloads", required=True)
    c.add_argument("--filings", required=True)
    c.add_argument("--log", required=True)
    c.add_argument("--isin-cache")
    c.add_argument("--json-out")
    c.add_argument("--download-dir", help="folder of the files named by the payloads of kind download")
    c.add_argument("--as-of", help="start of the run (ISO, UTC unless it has a zone); now if left out")
    c.add_argument("--period", type=int, default=2, choices=range(0, 5))
    c.add_argument("--max-pages", type=int, default=1)
    c.add_argument("--mode", choices=("replace", "preserve"), default="replace",
                   help="replace: a re-crawl resets download fields (source behaviour); preserve keeps them")
    s = sub.add_parser("stats")
    s.add_argument("--filings", required=True)
    s.add_argument("--log", required=True)
    s.add_argument("--docs", required=True)
    s.add_argument("--as-of")
    s.add_argument("--json", action="store_true")
    e = sub.add_parser("export")
    e.add_argument("--src", required=True)
    e.add_argument("--dest", required=True)
    m = sub.add_parser("monitor")
    m.add_argument("--landing", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--cache")
    m.add_argument("--start-key", type=int)
    m.add_argument("--baseline-payloads")
    m.add_argument("--key-col", default="key")
    m.add_argument("--ts-col", default="ts")
    m.add_argument("--source-col", help="rows: keys are per value of this column")
    m.add_argument("--filings", help="payloads: the filings table (default: OUT/filings)")
    m.add_argument("--json-out", help="payloads: JSON document that new filings are appended to")
    m.add_argument("--as-of", help="payloads: time of the rows (ISO); now if left out")
    m.add_argument("--max-files", type=int, help="files of a micro-batch")
    m.add_argument("--interval", type=float, default=300, help="seconds between polls, unless a burst was found")
    m.add_argument("--once", action="store_true", help="consume what is there and stop")
    i = sub.add_parser("isin")
    i.add_argument("--payloads", required=True)
    i.add_argument("--cache", required=True)
    i.add_argument("--json-cache", help="JSON object {ticker: isin} to use where there is no cache")
    i.add_argument("--refresh", action="store_true")
    d = sub.add_parser("mark")
    d.add_argument("--filings", required=True)
    d.add_argument("--updates", required=True)
    k = sub.add_parser("cache")
    k.add_argument("--payloads", required=True)
    k.add_argument("--cache", required=True)
    k.add_argument("--start", type=int, required=True)
    k.add_argument("--end", type=int, required=True)
    k.add_argument("--as-of", required=True)
    for table in (c, k):
        table.add_argument("--buckets", type=int, default=FIRST_BUCKETS, help="buckets of a new table; it splits them as it grows")
    x = sub.add_parser("extract")
    x.add_argument("--filings")
    x.add_argument("--documents")
    x.add_argument("--out")
    x.add_argument("--file")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = build_parser().parse_args(argv)
    spark = spark or get_spark()
    fn = {"crawl": cmd_crawl, "stats": cmd_stats, "export": cmd_export, "monitor": cmd_monitor,
          "cache": cmd_cache, "extract": cmd_extract, "isin": cmd_isin, "mark": cmd_mark}[a.cmd]
    return fn(spark, a)


if __name__ == "__main__":
    sys.exit(main())
