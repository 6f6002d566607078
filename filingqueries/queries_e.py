"""Driver queries on stored tables and watched streams: point lookups (P5),
marking (M3), growth (M1), log events (M4, M5), written extractions (S13),
statistics with sizes (S11), bursts per source (X2, X3), pacing (X4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow import cli
from filingflow.operators.store import FILINGS_SCHEMA, TOKEN_CACHE_SCHEMA
from filingflow.operators.tables import lookup_key, mark_downloaded_table, probe, read_table, split_to, table_buckets, upsert_table
from filingflow.plans.extract import process_filings
from filingflow.plans.stats import compute_stats
from filingflow.session import new_run_dir
from filingflow.sources.documents import read_filings_document, write_extracted
from filingflow.sources.json_array import write_array
from filingflow.streaming.cycles import baseline_key, burst_log, fold_cycles, poll, watch
from filingflow.streaming.monitor import MonitorPaths, run_monitor, time_slices, write_drop
from . import fixtures as fx
from .queries_b import _Q16_SQL, T1, upserted_filings
from .queries_c import EVENT_COLS, _Q27_SQL, document_filings, ntz_lit
from .registry import query

_STORED_AT = "2024-05-01T00:00:00"


def _tokens(o: DataFrame, seq: int) -> DataFrame:
    k = F.col("o_orderkey")
    return o.select(k.alias("key"), F.concat(F.lit("T"), k.cast("string"), F.lit(f"-{seq}")).alias("enc"), *[F.lit("").alias(n) for n in ("emisora", "asunto", "fecha")],
                    F.lit(_STORED_AT).alias("resolved_at"), F.lit(seq).alias("_seq"), k.alias("_pos"))


def _stored_tokens(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A stored token table: two upserts of different keys, then growth."""
    table = f"{new_run_dir(spark, name)}/tokens"
    o = fx.read(spark, sf_dir, "orders").select("o_orderkey")
    upsert_table(spark, table, TOKEN_CACHE_SCHEMA, _tokens(o.filter("o_orderkey % 3 <> 0"), 1), ["key"], buckets=4)
    upsert_table(spark, table, TOKEN_CACHE_SCHEMA, _tokens(o.filter("o_orderkey % 2 = 0"), 2), ["key"])
    split_to(spark, table, TOKEN_CACHE_SCHEMA, ["key"], table_buckets(spark, table) + 3)
    return table


_TOKENS_SQL = """SELECT o_orderkey AS key, 'T' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN '-2' ELSE '-1' END AS enc
FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0"""


@query("q49_grown_table", _TOKENS_SQL)
def q49_grown_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table after upserts and bucket splits."""
    return read_table(spark, _stored_tokens(spark, sf_dir, "grown"), TOKEN_CACHE_SCHEMA).select("key", "enc")


@query("q50_lookups", f"""
WITH t AS ({_TOKENS_SQL})
SELECT 'few' AS how, key, enc FROM t WHERE key IN (SELECT max(o_orderkey) FROM orders)
UNION ALL SELECT 'many', key, enc FROM t WHERE key IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber >= 6)
""")
def q50_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key, and the keys of a batch, in a stored table; half of the
    batch's keys are not there."""
    table = _stored_tokens(spark, sf_dir, "lookups")
    top = fx.read(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    keys = fx.read(spark, sf_dir, "lineitem").filter("l_linenumber >= 6").select(F.col("l_orderkey").alias("key"))
    keys = keys.unionByName(keys.select((-F.col("key")).alias("key")))
    few = lookup_key(spark, table, TOKEN_CACHE_SCHEMA, top).select(F.lit("few").alias("how"), "key", "enc")
    return few.unionByName(probe(spark, table, TOKEN_CACHE_SCHEMA, keys).select(F.lit("many").alias("how"), "key", "enc"))


@query("q51_mark_table", _Q16_SQL)
def q51_mark_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q16 on a stored table: only the updates' buckets are rewritten."""
    table = f"{new_run_dir(spark, 'mark')}/filings"
    rows = upserted_filings(spark, sf_dir).withColumn("_seq", F.lit(1)).withColumn("_pos", F.col("filing_id"))
    upsert_table(spark, table, FILINGS_SCHEMA, rows, ["filing_id"])
    k = F.col("o_orderkey")
    updates = fx.read(spark, sf_dir, "orders").filter((k % 4 == 1) | (k % 50 == 0)).select(
        F.concat(F.when(k % 4 == 1, F.lit("cnbv_")).otherwise(F.lit("cnbv_x")), k.cast("string")).alias("filing_id"),
        F.concat(F.lit("/pdf/"), k.cast("string")).alias("download_path"), k.alias("seq"))
    mark_downloaded_table(spark, table, updates)
    return read_table(spark, table, FILINGS_SCHEMA).select("filing_id", "downloaded", "download_path")


@query("q52_log_events", """
SELECT 'crawl' AS crawl_type, CAST(n AS INTEGER) AS filings_found, CAST(1 AS INTEGER) AS pages_crawled, CAST(90.0 AS DOUBLE) AS duration_seconds,
       '2024-05-01T10:00:00' AS started_at FROM (SELECT count(*) AS n FROM orders)
UNION ALL SELECT 'monitor', 0, 0, NULL, '2024-05-01T10:00:00'
""")
def q52_log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that start at once: one completes twice (the later counts), one
    never does."""
    log = new_run_dir(spark, "log")
    start = dt.datetime(2024, 5, 1, 10, tzinfo=dt.timezone.utc)
    found = fx.read(spark, sf_dir, "orders").count()
    first = cli.log_start(spark, log, "crawl", {"period": 2}, start)
    cli.log_start(spark, log, "monitor", {}, start)
    cli.log_complete(spark, log, first, 1, 1, 9, "retried", start + dt.timedelta(seconds=30))
    cli.log_complete(spark, log, first, found, found, 1, None, start + dt.timedelta(seconds=90))
    return cli.read_log(spark, log).select("crawl_type", "filings_found", "pages_crawled", "duration_seconds", "started_at")


@query("q53_extracted_sink", f"SELECT key, document_type, n_chars, count(*) OVER () AS total_processed FROM ({_Q27_SQL})")
def q53_extracted_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted documents written with their metadata, and read back."""
    out = f"{new_run_dir(spark, 'extracted')}/x"
    write_extracted(process_filings(*document_filings(spark, sf_dir)).select("filing", "source_file", "extracted"), out, "native")
    total = spark.read.json(f"{out}/metadata").first()["total_processed"]
    docs = spark.read.json(f"{out}/documents")
    return docs.select(F.col("filing.key").alias("key"), F.col("extracted.document_type").alias("document_type"),
                       F.length("extracted.raw_text").alias("n_chars"), F.lit(total).cast("long").alias("total_processed"))


@query("q54_stats_sizes", """
SELECT CAST((SELECT count(*) FROM orders WHERE o_orderkey % 7 <> 3) AS BIGINT) AS total_filings, CAST(sum(strlen(text) + 1) AS BIGINT) AS documents_size_bytes,
       true AS has_table_bytes FROM documents
""")
def q54_stats_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics record over a stored table, with the documents' size."""
    run = new_run_dir(spark, "stats")
    from filingflow.operators.store import filing_record, to_filings_rows
    f = fx.order_filings(spark, sf_dir).filter(F.col("key").isNotNull()).select("fecha", "emisora", "asunto", "key")
    rows = to_filings_rows(filing_record(f, T1), T1, None).withColumn("_seq", F.lit(1)).withColumn("_pos", F.col("filing_id"))
    upsert_table(spark, f"{run}/filings", FILINGS_SCHEMA, rows, ["filing_id"])
    fx.read(spark, sf_dir, "documents").select("text").write.text(f"{run}/docs/nested")
    s = compute_stats(spark, f"{run}/filings", cli.read_log(spark, f"{run}/log"), f"{run}/docs", dt.datetime(2024, 5, 1))
    return spark.createDataFrame([(s["total_filings"], s["documents_size_bytes"], s["db_size_bytes"] > 0)],
                                 "total_filings long, documents_size_bytes long, has_table_bytes boolean")


# rows of each event type and drop above the baseline; the last drop repeats every tenth event
_SOURCE_FOLD = """
WITH RECURSIVE
bnd AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
base AS (SELECT max(event_id) AS k FROM events WHERE ts < (SELECT min(ts) FROM events) + INTERVAL 1 DAY),
e AS (SELECT event_type AS source, event_id, least(3, CAST(floor((epoch_us(ts) - lo) / ((hi - lo) / 4.0)) AS INTEGER)) AS sl FROM events, bnd
      WHERE event_id > (SELECT k FROM base)),
cnt AS (SELECT source, CASE sl WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE sl END AS batch_id, count(*) AS n, max(event_id) AS mx FROM e GROUP BY ALL
        UNION ALL SELECT DISTINCT source, 4, 0, NULL FROM e WHERE event_id % 10 = 0),
ord AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY batch_id) AS i, max(mx) OVER (PARTITION BY source ORDER BY batch_id) AS last_key FROM cnt),
fold(source, batch_id, n, last_key, i, la, mode) AS (
  SELECT source, batch_id, n, last_key, i, CASE WHEN n > 0 AND n >= 3 THEN 10 ELSE 5 END,
         CASE WHEN n > 0 AND n >= 3 THEN 'burst' WHEN n > 0 THEN 'normal' ELSE 'idle' END FROM ord WHERE i = 1
  UNION ALL
  SELECT o.source, o.batch_id, o.n, o.last_key, o.i, CASE WHEN o.n > 0 AND o.n >= f.la - 2 THEN least(f.la * 2, 200) ELSE 5 END,
         CASE WHEN o.n > 0 AND o.n >= f.la - 2 THEN 'burst' WHEN o.n > 0 THEN 'normal' ELSE 'idle' END
  FROM fold f JOIN ord o ON o.source = f.source AND o.i = f.i + 1)
"""


def _watched(spark: SparkSession, sf_dir: str, source_col: str | None):
    """Drops as in q30, and how to poll them."""
    run = new_run_dir(spark, "watched")
    paths = MonitorPaths(f"{run}/landing", f"{run}/sink", f"{run}/state", f"{run}/ckpt")
    e = fx.read(spark, sf_dir, "events").select(*EVENT_COLS)
    first_day = e.agg(F.min("ts")).first()[0]
    cached = e.filter(F.col("ts") < ntz_lit(first_day + dt.timedelta(days=1))).select(F.col("event_id").alias("key"))
    base = baseline_key(spark, paths.state, cached)
    a, b, c, d = time_slices(e, 4, "ts")

    def run_once():
        run_monitor(spark, paths, e.schema, base, key_col="event_id", ts_col="ts", source_col=source_col)

    return paths, (a, b, d, c, e.filter(F.col("event_id") % 10 == 0)), run_once


@query("q55_source_bursts", _SOURCE_FOLD + """
SELECT source, CAST(batch_id AS BIGINT) AS batch_id, CAST(n AS BIGINT) AS new_count, CAST(last_key AS BIGINT) AS last_key, CAST(la AS INTEGER) AS look_ahead, mode FROM fold
""")
def q55_source_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-water mark and look-ahead per event type, as keyed state."""
    paths, drops, run_once = _watched(spark, sf_dir, "event_type")
    for drop in drops:
        write_drop(drop, paths.landing)
        run_once()
        fold_cycles(spark, paths.state)
    return burst_log(spark, paths.state)


@query("q56_poll_pacing", """
WITH RECURSIVE
bnd AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
base AS (SELECT max(event_id) AS k FROM events WHERE ts < (SELECT min(ts) FROM events) + INTERVAL 1 DAY),
e AS (SELECT least(3, CAST(floor((epoch_us(ts) - lo) / ((hi - lo) / 4.0)) AS INTEGER)) AS sl FROM events, bnd WHERE event_id > (SELECT k FROM base)),
cnt AS (SELECT i, CASE WHEN i < 4 THEN (SELECT count(*) FROM e WHERE sl = CASE i WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE i END) ELSE 0 END AS n FROM range(6) t(i)),
fold(i, n, la, mode) AS (
  SELECT CAST(i AS INTEGER), n, CASE WHEN n > 0 AND n >= 3 THEN 10 ELSE 5 END, CASE WHEN n > 0 AND n >= 3 THEN 'burst' WHEN n > 0 THEN 'normal' ELSE 'idle' END FROM cnt WHERE i = 0
  UNION ALL
  SELECT CAST(c.i AS INTEGER), c.n, CASE WHEN c.n > 0 AND c.n >= f.la - 2 THEN least(f.la * 2, 200) ELSE 5 END,
         CASE WHEN c.n > 0 AND c.n >= f.la - 2 THEN 'burst' WHEN c.n > 0 THEN 'normal' ELSE 'idle' END FROM fold f JOIN cnt c ON c.i = f.i + 1)
SELECT i AS poll, mode, CAST(CASE WHEN mode = 'burst' OR i = 5 THEN 0 ELSE 300 END AS INTEGER) AS waited FROM fold
""")
def q56_poll_pacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six polls, a drop before each but the last: the mode of each, and the
    seconds that the watch waits after it (an injected clock)."""
    paths, drops, run_once = _watched(spark, sf_dir, None)
    modes: list[str] = []
    waits: dict[int, int] = {}

    def once() -> str:
        if len(modes) < len(drops):
            write_drop(drops[len(modes)], paths.landing)
        modes.append(poll(spark, paths.state, run_once))
        return modes[-1]

    watch(once, 300, lambda s: waits.update({len(modes) - 1: int(s)}), polls=len(drops) + 1)
    return spark.createDataFrame([(i, m, waits.get(i, 0)) for i, m in enumerate(modes)], "poll int, mode string, waited int")


@query("q57_json_document", f"""
WITH {fx.ORDER_FILINGS_SQL}
SELECT fecha, coalesce(emisora, '') AS emisora, asunto, key FROM order_filings
""")
def q57_json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All filings in one JSON document, as the source system writes it, read
    in byte ranges. The file is written as one stream of lines."""
    path = f"{new_run_dir(spark, 'json-document')}/doc"
    f = fx.order_filings(spark, sf_dir).select("fecha", F.coalesce("emisora", F.lit("")).alias("emisora"), "asunto", "key")
    record = F.to_json(F.struct("fecha", "emisora", "asunto", "key", F.struct(F.lit('"]} {').alias("x")).alias("extra")), {"ignoreNullFields": "false"})
    write_array(f.select(record.alias("element")), path, '{"metadata": {"source": "x", "filings": [{"no": 1}]}, "filings": [', "]}")
    return read_filings_document(spark, path).select("fecha", "emisora", "asunto", "key")
