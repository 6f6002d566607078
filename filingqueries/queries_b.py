"""Driver queries q13-q25: token cache, upserts, crawl log, health, stats,
batching, page limits, periods, miss streaks, model JSON, JSON documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.functions.dates import iso_text
from filingflow.functions.docs import to_json_text, top_level_field_count, with_model_json
from filingflow.functions.text import token_from_callback
from filingflow.operators import aggregates as A
from filingflow.operators.filters import filter_by_period, limit_pages
from filingflow.operators.joins import new_ids, resolve_tokens
from filingflow.operators.store import (TOKEN_CACHE_SCHEMA, crawl_log, evolve, filing_record,
                               to_filings_rows, upsert)
from filingflow.operators.windows import chunk_batches, global_row_number, latest_per_key, miss_streak_cut
from filingflow.session import ensure_conf, new_run_dir, reliable_checkpoint
from filingflow.sources.documents import read_filings_document, write_filings_document
from . import fixtures as fx
from .queries_a import missing_order_keys
from .registry import query
from .sqlparts import classify_sql, filing_id_sql, iso_sql

OF = fx.ORDER_FILINGS_SQL
T0, T1 = "2024-01-01T00:00:00", "2024-01-02T00:00:00"


# ---------------------------------------------------------------------------
# q13 J3 + M2
# ---------------------------------------------------------------------------

_TOK = fx.TOKEN_SQL.format(k="o_orderkey")
_Q13_SQL = f"""
SELECT o_orderkey AS key,
  CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 10 <> 0 THEN 'C' || CAST(o_orderkey AS VARCHAR)
       WHEN o_orderkey % 3 = 0 AND o_orderkey % 11 <> 0 THEN {_TOK} END AS enc,
  CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 10 <> 0 THEN 'cache'
       WHEN o_orderkey % 3 = 0 AND o_orderkey % 11 <> 0 THEN 'payload' END AS resolved_from,
  CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 10 <> 0 THEN 'C' || CAST(o_orderkey AS VARCHAR)
       WHEN o_orderkey % 3 = 0 AND o_orderkey % 11 <> 0 THEN {_TOK}
       WHEN o_orderkey % 10 = 0 THEN '' END AS cached_after
FROM orders
"""


def token_cache_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token cache: even order keys; every 10th holds an empty (falsy) token."""
    k = F.col("o_orderkey")
    o = fx.read(spark, sf_dir, "orders").select("o_orderkey").filter(k % 2 == 0)
    return o.select(k.alias("key"),
                    F.when(k % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("C"), k.cast("string"))).alias("enc"),
                    *[F.lit("").alias(n) for n in ("emisora", "asunto", "fecha")],
                    F.lit(T0).alias("resolved_at"))


@query("q13_cache_first", _Q13_SQL)
def q13_cache_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    keys = fx.read(spark, sf_dir, "orders").select(k.alias("key"))
    cache = token_cache_from_orders(spark, sf_dir)
    payloads = (fx.read(spark, sf_dir, "orders").select("o_orderkey").filter(k % 3 == 0)
                  .select(k.alias("key"), token_from_callback(fx.render_token_callback(k)).alias("enc")))
    resolved = resolve_tokens(keys, cache, payloads)
    fresh = (resolved.filter(F.col("resolved_from") == "payload")
                     .select("key", "enc", *[F.lit("").alias(n) for n in ("emisora", "asunto", "fecha")],
                             F.lit(T1).alias("resolved_at"),
                             F.lit(1).alias("_seq"), F.col("key").alias("_pos")))
    new_cache = upsert(evolve(cache, TOKEN_CACHE_SCHEMA), fresh, ["key"])
    return (resolved.join(new_cache.select("key", F.col("enc").alias("cached_after")), "key", "left")
                    .select("key", "enc", "resolved_from", "cached_after"))


# ---------------------------------------------------------------------------
# q14-q16 upsert, new counts, mark downloaded
# ---------------------------------------------------------------------------

def _records(f: DataFrame, seq: int, pos, prefix: str, path) -> DataFrame:
    return f.select(
        "fecha", "emisora",
        F.concat(F.lit(prefix), F.col("asunto")).alias("asunto") if prefix else F.col("asunto"),
        "key", F.lit(None).cast("string").alias("enc"), path.alias("pdf_path"),
        F.lit(None).cast("string").alias("filing_type"),
        F.lit(T0 if seq == 0 else T1).alias("scraped_at"),
        F.lit(seq).cast("long").alias("_seq"), pos.cast("long").alias("_pos"))


def upsert_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Base filings (even orders, seq 0) and a batch (every 3rd order, with
    a second copy of every 9th: the later copy wins)."""
    f = fx.order_filings(spark, sf_dir)
    k = F.col("o_orderkey")
    base = _records(f.filter(k % 2 == 0), 0, k, "",
                    F.when(k % 4 == 0, F.concat(F.lit("/docs/"), k.cast("string"), F.lit(".pdf"))))
    path2 = F.when(k % 6 == 0, F.concat(F.lit("/docs2/"), k.cast("string"), F.lit(".pdf")))
    b1 = _records(f.filter(k % 3 == 0), 1, k * 2, "v2 ", path2)
    b2 = _records(f.filter(k % 9 == 0), 1, k * 2 + 1, "v3 ", path2)
    return base, b1.unionByName(b2)


def upserted_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, batch = upsert_inputs(spark, sf_dir)
    existing = latest_per_key(to_filings_rows(base, T0, None, carry=["_seq", "_pos"]),
                              ["filing_id"], ["_seq", "_pos"]).drop("_seq", "_pos")
    batch_rows = to_filings_rows(batch, T1, None, carry=["_seq", "_pos"])
    return upsert(existing, batch_rows, ["filing_id"])


UPSERT_SQL = f"""
{OF},
recs AS (
  SELECT 0 AS seq, o_orderkey AS pos, fecha, emisora, asunto, key,
         CASE WHEN o_orderkey % 4 = 0 THEN '/docs/' || CAST(o_orderkey AS VARCHAR) || '.pdf' END AS pdf_path
  FROM order_filings WHERE o_orderkey % 2 = 0
  UNION ALL
  SELECT 1, 2 * o_orderkey, fecha, emisora, 'v2 ' || asunto, key,
         CASE WHEN o_orderkey % 6 = 0 THEN '/docs2/' || CAST(o_orderkey AS VARCHAR) || '.pdf' END
  FROM order_filings WHERE o_orderkey % 3 = 0
  UNION ALL
  SELECT 1, 2 * o_orderkey + 1, fecha, emisora, 'v3 ' || asunto, key,
         CASE WHEN o_orderkey % 6 = 0 THEN '/docs2/' || CAST(o_orderkey AS VARCHAR) || '.pdf' END
  FROM order_filings WHERE o_orderkey % 9 = 0),
typed AS (
  SELECT *, {classify_sql('asunto')} AS filing_type,
         CASE WHEN seq = 0 THEN '{T0}' ELSE '{T1}' END AS ts,
         {filing_id_sql()} AS filing_id
  FROM recs),
rowsx AS (
  SELECT filing_id, 'cnbv' AS source, 'MX' AS country, coalesce(emisora, '') AS ticker,
         CAST(NULL AS VARCHAR) AS isin, coalesce(emisora, '') AS company_name,
         substr(fecha, 7, 4) || '-' || substr(fecha, 4, 2) || '-' || substr(fecha, 1, 2) AS filing_date,
         '' AS filing_time, asunto AS headline, filing_type, '' AS category, '' AS document_url,
         '' AS direct_download_url, '' AS file_size, CAST(NULL AS INTEGER) AS num_pages,
         false AS price_sensitive, coalesce(pdf_path <> '', false) AS downloaded,
         coalesce(pdf_path, '') AS download_path,
         to_json(struct_pack(fecha := fecha, emisora := emisora, asunto := asunto, key := key,
                             enc := CAST(NULL AS VARCHAR), pdf_path := pdf_path,
                             filing_type := filing_type, scraped_at := ts)) AS raw_metadata,
         ts AS created_at,
         row_number() OVER (PARTITION BY filing_id ORDER BY seq DESC, pos DESC) AS rn
  FROM typed),
upserted AS (SELECT * EXCLUDE (rn) FROM rowsx WHERE rn = 1)"""


@query("q14_upsert", f"WITH {UPSERT_SQL} SELECT * FROM upserted")
def q14_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upserted_filings(spark, sf_dir)


_Q15_SQL = f"""
WITH {UPSERT_SQL},
b AS (SELECT * FROM typed WHERE seq = 1),
existing AS (SELECT DISTINCT filing_id FROM typed WHERE seq = 0)
SELECT CAST(count(*) AS BIGINT) AS filings_found,
  CAST((SELECT count(DISTINCT filing_id) FROM b WHERE filing_id NOT IN (SELECT filing_id FROM existing)) AS BIGINT) AS filings_new,
  1 AS pages_crawled,
  CAST(count(*) FILTER (WHERE pdf_path <> '') AS BIGINT) AS pdfs_downloaded,
  CAST(count(*) - count(*) FILTER (WHERE pdf_path <> '') AS BIGINT) AS pdfs_failed
FROM b
"""


@query("q15_new_counts", _Q15_SQL)
def q15_new_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, batch = upsert_inputs(spark, sf_dir)
    existing = to_filings_rows(base, T0, None).select("filing_id")
    batch_rows = to_filings_rows(batch, T1, None)
    fresh = new_ids(batch_rows, existing).agg(F.count("*").alias("filings_new"))
    tallies = A.run_tallies(batch.withColumn("downloads_enabled", F.lit(True)), max_pages=0)
    return (tallies.withColumn("_k", F.lit(1)).join(F.broadcast(fresh.withColumn("_k", F.lit(1))), "_k")
                   .select("filings_found", "filings_new", "pages_crawled", "pdfs_downloaded", "pdfs_failed"))


_Q16_SQL = f"""
WITH {UPSERT_SQL},
upd AS (
  SELECT 'cnbv_' || CAST(o_orderkey AS VARCHAR) AS filing_id, '/pdf/' || CAST(o_orderkey AS VARCHAR) AS path
  FROM orders WHERE o_orderkey % 4 = 1)
SELECT u.filing_id, CASE WHEN upd.path IS NOT NULL THEN true ELSE u.downloaded END AS downloaded,
       coalesce(upd.path, u.download_path) AS download_path
FROM upserted u LEFT JOIN upd ON u.filing_id = upd.filing_id
"""


@query("q16_mark_downloaded", _Q16_SQL)
def q16_mark_downloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filingflow.operators.joins import mark_downloaded
    k = F.col("o_orderkey")
    o = fx.read(spark, sf_dir, "orders").select("o_orderkey")
    known = o.filter(k % 4 == 1).select(
        F.concat(F.lit("cnbv_"), k.cast("string")).alias("filing_id"),
        F.concat(F.lit("/pdf/"), k.cast("string")).alias("download_path"), k.alias("seq"))
    unknown = o.filter(k % 50 == 0).select(
        F.concat(F.lit("cnbv_x"), k.cast("string")).alias("filing_id"),
        F.lit("/pdf/none").alias("download_path"), k.alias("seq"))
    out = mark_downloaded(upserted_filings(spark, sf_dir), known.unionByName(unknown))
    return out.select("filing_id", "downloaded", "download_path")


# ---------------------------------------------------------------------------
# q17 crawl log
# ---------------------------------------------------------------------------

def run_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Crawl runs derived from events: one run per (user, day). Start events
    get ids in (day, user) order (W7). Users with id % 7 = 0 never complete;
    every 5th run also has an older, superseded completion; completions for
    unknown ids are appended too (ignored by the log)."""
    e = fx.read(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    runs = (e.groupBy("user_id", F.to_date("ts").alias("day"))
             .agg(F.min("ts").alias("s"), F.max("ts").alias("e"), F.count("*").alias("n"),
                  F.count_if(F.col("event_type") == "error").alias("nerr"),
                  F.count_if(F.col("event_type") == "purchase").alias("np")))
    runs = global_row_number(runs, ["day", "user_id"], "id")
    starts = runs.select(
        "id", F.lit("crawl").alias("crawl_type"),
        to_json_text((F.col("user_id") % 5).cast("string").alias("period"),
                     F.col("n").alias("max_pages")).alias("query_params"),
        iso_text("s").alias("started_at"), "user_id", "day")
    errors = (F.when(F.col("nerr") > 0, F.concat(F.col("nerr").cast("string"), F.lit(" errors")))
               .when(F.col("user_id") % 3 == 1, F.lit(" ")))
    done = runs.filter(F.col("user_id") % 7 != 0)
    final = done.select("id", F.lit(2).alias("seq"), F.col("n").cast("int").alias("filings_found"),
                        F.col("np").cast("int").alias("filings_new"),
                        F.greatest(F.lit(1), F.floor(F.col("n") / 20)).cast("int").alias("pages_crawled"),
                        errors.alias("errors"), F.col("e").cast("timestamp").alias("completed_ts"))
    older = done.filter(F.col("id") % 5 == 0).select(
        "id", F.lit(1).alias("seq"), F.lit(0).alias("filings_found"), F.lit(0).alias("filings_new"),
        F.lit(0).alias("pages_crawled"), F.lit("superseded").alias("errors"),
        F.col("s").cast("timestamp").alias("completed_ts"))
    unknown = done.filter(F.col("id") % 97 == 0).select(
        (-F.col("id")).alias("id"), F.lit(3).alias("seq"), F.lit(9).alias("filings_found"),
        F.lit(9).alias("filings_new"), F.lit(9).alias("pages_crawled"), F.lit("x").alias("errors"),
        F.col("e").cast("timestamp").alias("completed_ts"))
    return starts, final.unionByName(older).unionByName(unknown)


RUNS_SQL = f"""
runs AS (
  SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS s, max(ts) AS e, count(*) AS n,
         count(*) FILTER (WHERE event_type = 'error') AS nerr,
         count(*) FILTER (WHERE event_type = 'purchase') AS np
  FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (ORDER BY day, user_id) AS id FROM runs),
log AS (
  SELECT CAST(id AS BIGINT) AS id, 'crawl' AS crawl_type, 'cnbv' AS source,
    to_json(struct_pack(period := CAST(user_id % 5 AS VARCHAR), max_pages := n)) AS query_params,
    CAST(CASE WHEN user_id % 7 <> 0 THEN n ELSE 0 END AS INTEGER) AS filings_found,
    CAST(CASE WHEN user_id % 7 <> 0 THEN np ELSE 0 END AS INTEGER) AS filings_new,
    CAST(CASE WHEN user_id % 7 <> 0 THEN greatest(1, floor(n / 20)) ELSE 0 END AS INTEGER) AS pages_crawled,
    CASE WHEN user_id % 7 = 0 THEN NULL WHEN nerr > 0 THEN CAST(nerr AS VARCHAR) || ' errors'
         WHEN user_id % 3 = 1 THEN ' ' END AS errors,
    {iso_sql('s')} AS started_at,
    CASE WHEN user_id % 7 <> 0 THEN {iso_sql('e')} END AS completed_at,
    CASE WHEN user_id % 7 <> 0 THEN (epoch_us(e) - epoch_us(s)) / 1e6 END AS duration_seconds,
    user_id, day, e AS completed_ts
  FROM r)"""


def current_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts, completions = run_events(spark, sf_dir)
    return crawl_log(starts.drop("user_id", "day"), completions)


@query("q17_crawl_log", f"WITH {RUNS_SQL} SELECT * EXCLUDE (user_id, day, completed_ts) FROM log")
def q17_crawl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_log(spark, sf_dir)


# ---------------------------------------------------------------------------
# q18 health per user
# ---------------------------------------------------------------------------

def events_as_of(spark: SparkSession, sf_dir: str) -> dt.datetime:
    """One hour after the last event (a scalar, read once)."""
    last = fx.read(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    return last + dt.timedelta(hours=1)


_AS_OF_SQL = "((SELECT max(ts) FROM events) + INTERVAL 1 HOUR)"
_Q18_INNER = f"""
WITH {RUNS_SQL},
kept AS (
  SELECT * FROM log
  WHERE user_id % 13 <> 12
    AND NOT (user_id % 11 = 4 AND day > CAST({_AS_OF_SQL} AS DATE) - INTERVAL 4 DAY)),
lastrun AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY id DESC) AS rn FROM kept),
users AS (SELECT DISTINCT user_id FROM events)
SELECT u.user_id, l.id AS last_run_id,
  CASE WHEN l.id IS NULL THEN 'empty'
       WHEN l.completed_at IS NULL THEN 'error'
       WHEN (epoch_us({_AS_OF_SQL}) - epoch_us(l.completed_ts)) / 3600000000.0 > 48 THEN 'stale'
       WHEN trim(coalesce(l.errors, '')) <> '' THEN 'degraded'
       ELSE 'ok' END AS health
FROM users u LEFT JOIN (SELECT * FROM lastrun WHERE rn = 1) l ON u.user_id = l.user_id
"""
_Q18_SQL = f"""
SELECT *, CASE health WHEN 'ok' THEN 0 WHEN 'degraded' THEN 0 WHEN 'stale' THEN 1 WHEN 'empty' THEN 2
                      ELSE 3 END AS exit_code
FROM ({_Q18_INNER}) h
"""


@query("q18_health", _Q18_SQL)
def q18_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = events_as_of(spark, sf_dir)
    starts, completions = run_events(spark, sf_dir)
    cutoff = (as_of.date() - dt.timedelta(days=4))
    keep = starts.filter((F.col("user_id") % 13 != 12) &
                         ~((F.col("user_id") % 11 == 4) & (F.col("day") > F.lit(cutoff))))
    log = crawl_log(keep.drop("day"), completions, carry=["user_id"])
    users = fx.read(spark, sf_dir, "events").select("user_id").distinct()
    return A.health_per_group(users, log, "user_id", as_of).select("user_id", "last_run_id", "health",
                                                                   "exit_code")


# ---------------------------------------------------------------------------
# q19 stats record
# ---------------------------------------------------------------------------

_Q19_SQL = f"""
WITH {UPSERT_SQL}, {RUNS_SQL},
f AS (
  SELECT CAST(count(*) AS BIGINT) AS total_filings,
         CAST(count(*) FILTER (WHERE downloaded) AS BIGINT) AS downloaded,
         CAST(count(DISTINCT CASE WHEN ticker <> '' THEN ticker END) AS BIGINT) AS unique_companies,
         min(filing_date) AS earliest_record, max(filing_date) AS latest_record
  FROM upserted),
g AS (SELECT CAST(count(completed_at) AS BIGINT) AS total_crawl_runs FROM log),
lastlog AS (SELECT * FROM log ORDER BY id DESC LIMIT 1)
SELECT 'mexico-scraper' AS scraper, 'MX' AS country, total_filings, downloaded,
       total_filings - downloaded AS pending_download, unique_companies, total_crawl_runs,
       earliest_record, latest_record,
       (SELECT CASE WHEN completed_at IS NULL THEN 'error'
                    WHEN (epoch_us({_AS_OF_SQL}) - epoch_us(completed_ts)) / 3600000000.0 > 48 THEN 'stale'
                    WHEN trim(coalesce(errors, '')) <> '' THEN 'degraded' ELSE 'ok' END FROM lastlog) AS health
FROM f, g
"""


@query("q19_stats", _Q19_SQL)
def q19_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = events_as_of(spark, sf_dir)
    rec = A.stats_record(upserted_filings(spark, sf_dir), current_log(spark, sf_dir), as_of)
    return rec.drop("sources", "db_size_bytes", "documents_size_bytes")


# ---------------------------------------------------------------------------
# q20 batches
# ---------------------------------------------------------------------------

WORKERS = 10
_Q20_SQL = f"""
WITH m AS (
  SELECT k AS key
  FROM (SELECT unnest(range((SELECT min(o_orderkey) FROM orders), (SELECT max(o_orderkey) FROM orders) + 1)) AS k) r
  WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = r.k)),
sz AS (SELECT greatest(20, count(*) // {WORKERS}) AS size FROM m)
SELECT key, CAST((row_number() OVER (ORDER BY key) - 1) // (SELECT size FROM sz) AS BIGINT) AS batch_id
FROM m
"""


@query("q20_batches", _Q20_SQL)
def q20_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    miss = reliable_checkpoint(missing_order_keys(spark, sf_dir))
    total = miss.count()
    numbered = global_row_number(miss, ["key"], "rn")
    return chunk_batches(numbered, "rn", total, WORKERS).select("key", "batch_id")


# ---------------------------------------------------------------------------
# q21 page limit
# ---------------------------------------------------------------------------

_LIMITS = (0, 30, -1)
_Q21_SQL = f"""
WITH {OF},
shown AS (SELECT o_orderkey, page FROM order_filings WHERE page <> (SELECT max(page) - 3 FROM order_filings)),
tot AS (SELECT max(page) AS total FROM order_filings),
fe AS (SELECT min(p) AS first_empty FROM (SELECT unnest(range(1, (SELECT total FROM tot) + 1)) AS p) r
       WHERE NOT EXISTS (SELECT 1 FROM shown WHERE shown.page = r.p)),
lim AS (SELECT * FROM (VALUES (0, 1), (30, 30), (-1, NULL)) v(max_pages, eff))
SELECT lim.max_pages, o_orderkey, page
FROM shown, lim
WHERE page <= coalesce(lim.eff, (SELECT total FROM tot))
  AND ((SELECT first_empty FROM fe) IS NULL OR page < (SELECT first_empty FROM fe))
"""


@query("q21_pages_limit", _Q21_SQL)
def q21_pages_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.order_filings(spark, sf_dir).select("o_orderkey", "page")
    total = int(f.agg(F.max("page")).first()[0] or 0)
    shown = f.filter(F.col("page") != total - 3)  # the empty page stands near the end
    outs = [limit_pages(shown, "page", m, total).withColumn("max_pages", F.lit(m)) for m in _LIMITS]
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out.select("max_pages", "o_orderkey", "page")


# ---------------------------------------------------------------------------
# q22 period filter
# ---------------------------------------------------------------------------

PERIOD_AS_OF = "1998-06-30"
_Q22_SQL = f"""
WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS filing_date FROM orders)
SELECT 0 AS period, o_orderkey FROM t
UNION ALL SELECT 1, o_orderkey FROM t WHERE filing_date = (SELECT max(filing_date) FROM t)
UNION ALL SELECT 2, o_orderkey FROM t
  WHERE CAST(filing_date AS DATE) BETWEEN DATE '{PERIOD_AS_OF}' - INTERVAL 180 DAY AND DATE '{PERIOD_AS_OF}'
UNION ALL SELECT 3, o_orderkey FROM t WHERE year(CAST(filing_date AS DATE)) = year(DATE '{PERIOD_AS_OF}')
UNION ALL SELECT 4, o_orderkey FROM t WHERE CAST(filing_date AS DATE) = DATE '{PERIOD_AS_OF}'
"""


@query("q22_period_filter", _Q22_SQL)
def q22_period_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fx.read(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("filing_date"))
    parts = [filter_by_period(o, "filing_date", p, PERIOD_AS_OF).select(F.lit(p).alias("period"), "o_orderkey")
             for p in range(5)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# q23 consecutive-miss cut
# ---------------------------------------------------------------------------

_Q23_SQL = """
WITH e AS (
  SELECT user_id, event_id, event_type <> 'error' AS hit,
         sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
           OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS misses,
         count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n
  FROM events),
stop AS (SELECT user_id, min(event_id) AS stop_id FROM e WHERE misses = 3 AND n = 3 GROUP BY user_id)
SELECT e.user_id, e.event_id FROM e LEFT JOIN stop USING (user_id)
WHERE hit AND (stop_id IS NULL OR event_id < stop_id)
"""


@query("q23_miss_streak", _Q23_SQL)
def q23_miss_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.read(spark, sf_dir, "events").select(
        "user_id", "event_id", (F.col("event_type") != "error").alias("hit"))
    return miss_streak_cut(e, ["user_id"], "event_id", "hit").select("user_id", "event_id")


# ---------------------------------------------------------------------------
# q24 fenced model JSON
# ---------------------------------------------------------------------------

def _model_text(eid, props):
    shape = eid % 5
    return (F.when(shape == 0, props)
             .when(shape == 1, F.concat(F.lit("```json\n"), props, F.lit("\n```")))
             .when(shape == 2, F.concat(F.lit("json "), props))
             .when(shape == 3, F.concat(F.lit("  ```\n"), props, F.lit("```  ")))
             .when(eid % 20 == 4, F.substring(props, F.lit(2), F.length(props)))
             # two values, no comma, no colon
             .when(eid % 20 == 9, F.concat(props, F.lit(","), props)).when(eid % 20 == 14, F.lit("[1 2]")).otherwise(F.lit('{"a" 1}')))


_Q24_SQL = """
WITH t AS (
  SELECT event_id, props,
    CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN '```json' || chr(10) || props || chr(10) || '```'
                      WHEN 2 THEN 'json ' || props WHEN 3 THEN '  ```' || chr(10) || props || '```  '
                      ELSE CASE event_id % 20 WHEN 4 THEN substr(props, 2) WHEN 9 THEN props || ',' || props
                                              WHEN 14 THEN '[1 2]' ELSE '{"a" 1}' END END AS text
  FROM events)
SELECT event_id, event_id % 5 = 4 AS parse_error,
  CASE WHEN event_id % 5 <> 4 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
  CAST(length(text) AS INTEGER) AS n_chars,
  CASE WHEN event_id % 5 <> 4 THEN CAST(len(json_keys(props)) AS INTEGER) END AS n_fields
FROM t
"""


@query("q24_fenced_json", _Q24_SQL)
def q24_fenced_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.read(spark, sf_dir, "events").select("event_id", "props")
    t = e.select("event_id", _model_text(F.col("event_id"), F.col("props")).alias("text"))
    t = with_model_json(t, "text", "js", "parse_error")
    return t.select("event_id", "parse_error",
                    F.get_json_object("js", "$.k").cast("bigint").alias("k"),
                    F.length("text").alias("n_chars"), top_level_field_count(F.col("js")).alias("n_fields"))


# ---------------------------------------------------------------------------
# q25 JSON document write/read
# ---------------------------------------------------------------------------

_Q25_SQL = f"""
WITH {OF}
SELECT coalesce(fecha, '') AS fecha, coalesce(emisora, '') AS emisora, coalesce(asunto, '') AS asunto, key,
  CAST(NULL AS VARCHAR) AS enc,
  CASE WHEN o_orderkey % 3 = 0 THEN '/docs/' || CAST(o_orderkey AS VARCHAR) || '.pdf' END AS pdf_path,
  {classify_sql('asunto')} AS filing_type, '{T0}' AS scraped_at,
  json_extract_string(to_json(struct_pack(k := key, h := asunto)), '$.h') AS raw_headline
FROM order_filings
"""


@query("q25_json_doc", _Q25_SQL)
def q25_json_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    f = fx.order_filings(spark, sf_dir)
    k = F.col("o_orderkey")
    rec = filing_record(
        f.select("fecha", "emisora", "asunto", "key",
                 F.when(k % 3 == 0, F.concat(F.lit("/docs/"), k.cast("string"), F.lit(".pdf"))).alias("pdf_path")),
        T0)
    from filingflow.functions.text import classify_filing_type
    rec = rec.withColumn("filing_type", classify_filing_type("asunto")) \
             .withColumn("raw", to_json_text(F.col("key").alias("k"), F.col("asunto").alias("h")))
    out = new_run_dir(spark, "filings-json")
    write_filings_document(rec, out, source="test", scraped_at=T0)
    back = read_filings_document(spark, out, rec.schema)
    return back.select("fecha", "emisora", "asunto", "key", "enc", "pdf_path", "filing_type", "scraped_at",
                       F.get_json_object("raw", "$.h").alias("raw_headline"))

