"""Driver queries q26-q44: archives, document extraction, schema evolution,
streaming monitor, file names, records, lookups, downloads, JSON pages,
tallies, document pages, encodings, ISIN cache, documents on disk."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow._col import ntz_lit
from filingflow.functions.dates import age_hours, epoch_ms_text
from filingflow.functions.docs import (attached_name, is_file_response, is_pdf_response, name_hint,
                              resolve_file_name, to_json_text)
from filingflow.functions.text import page_text, strip_ws, title_text, truthy
from filingflow.operators import aggregates as A
from filingflow.operators.archives import first_pages, zip_members
from filingflow.operators.filters import key_range, keyed_rows, take_until_short_page
from filingflow.operators.joins import merge_download_status
from filingflow.operators.parse import delta_hidden_fields, hidden_fields, json_page_items
from filingflow.operators.store import (FILINGS_DEFAULTS, FILINGS_SCHEMA, SCHEMA_VERSION, evolve, filing_record, schema_version,
                               to_filings_rows, write_schema_version)
from filingflow.operators.windows import latest_row
from filingflow.session import ensure_conf, new_run_dir
from filingflow.sources.documents import append_filings, export_document, read_filings_document, read_metadata, write_extracted
from filingflow.sources.files import dir_size
from filingflow.sources.isin import load_isin_map
from filingflow.streaming.cycles import baseline_key, burst_log, fold_cycles
from filingflow.streaming.monitor import MonitorPaths, run_daily_counts, run_monitor, time_slices, write_drop
from . import fixtures as fx
from filingflow.plans.extract import document_tallies, process_filings
from filingflow.plans.isin_build import PAGE_ITEMS, company_items
from .queries_a import _Q05_SQL, _Q10_SQL, q05_sanitize, q10_isin_build
from .queries_b import RUNS_SQL, _AS_OF_SQL, current_log, events_as_of, token_cache_from_orders
from .registry import query
from .sqlparts import classify_sql, filing_id_sql, html_text_sql, lit

OF = fx.ORDER_FILINGS_SQL
T0 = "2024-01-01T00:00:00"


# ---------------------------------------------------------------------------
# q26 zip members
# ---------------------------------------------------------------------------

MEMBER_SUFFIXES = [".pdf", ".xlsx", ".PNG", ".txt", ".xls", ".docx", ".jpeg"]
DOCS_PER_ARCHIVE = 10


def _build_zips(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Test fixture: one zip per group of (at most 10) documents; every 7th
    archive (id % 7 = 3) is cut short, i.e. corrupt."""
    for pdf in groups:
        aid = int(pdf["archive"].iloc[0])
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            for name, text in zip(pdf["member"], pdf["text"]):
                zf.writestr(name, (text or "").encode("utf-8"))
        data = buf.getvalue()
        if aid % 7 == 3:
            data = data[: len(data) // 2]
        yield pd.DataFrame({"archive": [str(aid)], "content": [data]})


def document_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fx.read(spark, sf_dir, "documents").select("doc_id", "text")
    members = d.select(
        F.floor(F.col("doc_id") / DOCS_PER_ARCHIVE).cast("long").alias("archive"),
        F.concat(F.col("doc_id").cast("string"), fx.pick(MEMBER_SUFFIXES, F.col("doc_id") % len(MEMBER_SUFFIXES)))
         .alias("member"), "text")
    return members.groupBy("archive").applyInPandas(_build_zips, "archive string, content binary")


_Q26_SQL = f"""
WITH m AS (
  SELECT CAST(doc_id // {DOCS_PER_ARCHIVE} AS VARCHAR) AS archive, doc_id // {DOCS_PER_ARCHIVE} AS aid,
         CAST(doc_id AS VARCHAR) || {fx.sql_list(MEMBER_SUFFIXES)}[(doc_id % {len(MEMBER_SUFFIXES)}) + 1] AS member,
         lower({fx.sql_list(MEMBER_SUFFIXES)}[(doc_id % {len(MEMBER_SUFFIXES)}) + 1]) AS suffix,
         CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes
  FROM documents)
SELECT archive, member, suffix, n_bytes,
       CAST(row_number() OVER (PARTITION BY archive ORDER BY member) - 1 AS INTEGER) AS member_pos,
       CASE WHEN suffix = '.pdf' THEN 'pdf' WHEN suffix IN ('.xls', '.xlsx') THEN 'spreadsheet'
            WHEN suffix = '.zip' THEN 'zip' ELSE 'unsupported' END AS kind
FROM m
WHERE suffix IN ('.pdf', '.xls', '.xlsx', '.png', '.jpg', '.jpeg', '.tiff', '.bmp') AND aid % 7 <> 3
"""


@query("q26_zip_members", _Q26_SQL)
def q26_zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filingflow.functions.docs import suffix_kind
    m = zip_members(document_archives(spark, sf_dir))
    return m.select("archive", "member", "suffix", "n_bytes", "member_pos", suffix_kind("member").alias("kind"))


# ---------------------------------------------------------------------------
# q27 document extraction
# ---------------------------------------------------------------------------

def document_filings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Filings pointing at documents (every 4th has '' and every 4th+1 a null
    path) and the documents keyed by path."""
    d = fx.read(spark, sf_dir, "documents").select("doc_id", "text")
    k = F.col("doc_id")
    # text files, and binary kinds that no text extractor may read
    path = F.concat(F.lit("/docs/"), k.cast("string"), F.when(k % 7 == 3, F.lit(".zip")).when(k % 7 == 5, F.lit(".xlsx")).otherwise(F.lit(".txt")))
    filings = d.select(F.col("doc_id").cast("string").alias("key"), F.lit("01/01/2024").alias("fecha"),
                       F.lit("DOC").alias("emisora"), F.concat(F.lit("Documento "), k.cast("string")).alias("asunto"),
                       F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit(None)).otherwise(path).alias("pdf_path"))
    docs = d.select(path.alias("source_file"), F.col("text").alias("content"))
    return filings, docs


def _model_like(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """An extractor shaped like a model client: fenced JSON for some
    documents, prose for others (the parse-error branch)."""
    import json
    for pdf in batches:
        out = []
        for path, content in zip(pdf["source_file"], pdf["content"]):
            doc_id = int(path.rsplit("/", 1)[-1].split(".")[0])
            body = json.dumps({"document_type": "extracted", "issuer": None, "key_terms": [],
                               "raw_text": content}, ensure_ascii=False)
            if doc_id % 13 == 0:
                text = f"Sorry, no JSON for document {doc_id}."
            elif doc_id % 3 == 0:
                text = "```json\n" + body + "\n```"
            else:
                text = body
            out.append((path, text))
        yield pd.DataFrame(out, columns=["source_file", "model_text"])


_Q27_SQL = f"""
SELECT CAST(doc_id AS VARCHAR) AS key, '/docs/' || CAST(doc_id AS VARCHAR) || '.txt' AS source_file,
       {classify_sql('text')} AS document_type, CAST(length(text) AS INTEGER) AS n_chars, false AS parse_error
FROM documents WHERE doc_id % 4 NOT IN (0, 1) AND doc_id % 7 NOT IN (3, 5)
"""


@query("q27_doc_extract", _Q27_SQL)
def q27_doc_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    filings, docs = document_filings(spark, sf_dir)
    out = process_filings(filings, docs)
    return out.select(F.col("filing.key").alias("key"), "source_file",
                      F.col("extracted.document_type").alias("document_type"),
                      F.length("extracted.raw_text").alias("n_chars"),
                      F.col("extracted._parse_error").alias("parse_error"))


_Q27B_SQL = """
SELECT CAST(doc_id AS VARCHAR) AS key,
       CASE WHEN doc_id % 13 = 0 THEN NULL ELSE 'extracted' END AS document_type,
       CAST(CASE WHEN doc_id % 13 = 0 THEN length('Sorry, no JSON for document ' || CAST(doc_id AS VARCHAR) || '.')
                 ELSE length(text) END AS INTEGER) AS n_chars,
       doc_id % 13 = 0 AS parse_error
FROM documents WHERE doc_id % 4 NOT IN (0, 1) AND doc_id % 7 NOT IN (3, 5)
"""


@query("q27b_doc_extract_model", _Q27B_SQL)
def q27b_doc_extract_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    filings, docs = document_filings(spark, sf_dir)
    out = process_filings(filings, docs, extractor=_model_like)
    return out.select(F.col("filing.key").alias("key"),
                      F.col("extracted.document_type").alias("document_type"),
                      F.length("extracted.raw_text").alias("n_chars"),
                      F.col("extracted._parse_error").alias("parse_error"))


_Q27C_SQL = """
SELECT CAST(count(*) AS BIGINT) AS total_filings,
       CAST(count(*) FILTER (WHERE doc_id % 4 NOT IN (0, 1)) AS BIGINT) AS processable,
       CAST(count(*) FILTER (WHERE doc_id % 4 NOT IN (0, 1) AND doc_id % 7 NOT IN (3, 5)) AS BIGINT) AS total_processed,
       CAST(count(*) FILTER (WHERE doc_id % 4 NOT IN (0, 1) AND doc_id % 7 IN (3, 5)) AS BIGINT) AS skipped
FROM documents
"""


@query("q27c_doc_tallies", _Q27C_SQL)
def q27c_doc_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    filings, docs = document_filings(spark, sf_dir)
    return document_tallies(filings, process_filings(filings, docs))


# ---------------------------------------------------------------------------
# q28 schema evolution (M7)
# ---------------------------------------------------------------------------

_Q28_SQL = f"""
WITH {OF}
SELECT {filing_id_sql()} AS filing_id, 'cnbv' AS source,
       'MX' AS country, CAST(NULL AS VARCHAR) AS isin, false AS downloaded, false AS price_sensitive,
       {classify_sql('asunto')} AS filing_type, CAST(NULL AS INTEGER) AS num_pages
FROM order_filings
"""


@query("q28_evolve", _Q28_SQL)
def q28_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.order_filings(spark, sf_dir).select("fecha", "emisora", "asunto", "key")
    old = to_filings_rows(filing_record(f, T0), T0, None).drop("isin", "source", "downloaded",
                                                                "price_sensitive", "num_pages")
    new = evolve(old, FILINGS_SCHEMA, FILINGS_DEFAULTS)
    return new.select("filing_id", "source", "country", "isin", "downloaded", "price_sensitive",
                      "filing_type", "num_pages")


# ---------------------------------------------------------------------------
# q29 / q30 streaming monitor
# ---------------------------------------------------------------------------

EVENT_COLS = ["event_id", "ts", "user_id", "event_type"]


def _monitor_run(spark: SparkSession, sf_dir: str) -> MonitorPaths:
    """Five drops, a monitor run after each: four event-time slices of which
    the last comes third (so new keys arrive late), the held-back slice, and
    every 10th event once more (duplicates that the sink must absorb)."""
    ensure_conf(spark)
    run = new_run_dir(spark, "monitor")
    paths = MonitorPaths(f"{run}/landing", f"{run}/sink", f"{run}/state", f"{run}/ckpt")
    e = fx.read(spark, sf_dir, "events").select(*EVENT_COLS)
    first_day = e.agg(F.min("ts")).first()[0]
    import datetime as dt
    cached = e.filter(F.col("ts") < ntz_lit(first_day + dt.timedelta(days=1))).select(F.col("event_id").alias("key"))
    base = baseline_key(spark, paths.state, cached)
    a, b, c, d = time_slices(e, 4, "ts")
    for drop in (a, b, d, c, e.filter(F.col("event_id") % 10 == 0)):
        write_drop(drop, paths.landing)
        run_monitor(spark, paths, e.schema, base, key_col="event_id", ts_col="ts")
    return paths


_Q29_SQL = """
SELECT DISTINCT event_id AS key FROM events
WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < (SELECT min(ts) FROM events) + INTERVAL 1 DAY)
"""


@query("q29_stream_new_keys", _Q29_SQL)
def q29_stream_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _monitor_run(spark, sf_dir)
    return spark.read.parquet(paths.sink).select("key")


# One micro-batch per drop: four event-time slices (cut on epoch microseconds,
# the last before the third), then the duplicate drop (no new key).
# The look-ahead fold is a recursive CTE over the batches.
_Q30_SQL = """
WITH RECURSIVE
bnd AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
base AS (SELECT max(event_id) AS k FROM events WHERE ts < (SELECT min(ts) FROM events) + INTERVAL 1 DAY),
sl AS (SELECT i,
              CASE WHEN i = 0 THEN NULL ELSE CAST(trunc(lo + ((hi - lo) / 4.0) * i) AS BIGINT) END AS a,
              CASE WHEN i = 3 THEN NULL ELSE CAST(trunc(lo + ((hi - lo) / 4.0) * (i + 1)) AS BIGINT) END AS z
       FROM bnd, range(4) t(i)),
cnt AS (
  SELECT CASE i WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE i END AS batch_id, (SELECT count(*) FROM events
                         WHERE (a IS NULL OR epoch_us(ts) >= a) AND (z IS NULL OR epoch_us(ts) < z)
                           AND event_id > (SELECT k FROM base)) AS n FROM sl
  UNION ALL SELECT 4, 0),
fold(batch_id, n, la, mode) AS (
  SELECT batch_id, n, CASE WHEN n > 0 AND n >= 3 THEN 10 ELSE 5 END,
         CASE WHEN n > 0 AND n >= 3 THEN 'burst' WHEN n > 0 THEN 'normal' ELSE 'idle' END
  FROM cnt WHERE batch_id = 0
  UNION ALL
  SELECT c.batch_id, c.n,
         CASE WHEN c.n > 0 AND c.n >= f.la - 2 THEN least(f.la * 2, 200) ELSE 5 END,
         CASE WHEN c.n > 0 AND c.n >= f.la - 2 THEN 'burst' WHEN c.n > 0 THEN 'normal' ELSE 'idle' END
  FROM fold f JOIN cnt c ON c.batch_id = f.batch_id + 1)
SELECT CAST(batch_id AS INTEGER) AS batch_id, CAST(n AS BIGINT) AS new_count, CAST(la AS INTEGER) AS look_ahead, mode
FROM fold
"""


@query("q30_stream_burst", _Q30_SQL)
def q30_stream_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _monitor_run(spark, sf_dir).state
    fold_cycles(spark, state)
    return burst_log(spark, state).select(F.col("batch_id").cast("int").alias("batch_id"), "new_count", "look_ahead", "mode")


# ---------------------------------------------------------------------------
# q31 file-name collisions (quirk 8)
# ---------------------------------------------------------------------------

_Q31_SQL = f"""
SELECT page_id, file_name, CAST(count(*) OVER (PARTITION BY file_name) AS BIGINT) AS n_same,
       count(*) OVER (PARTITION BY file_name) > 1 AS collides
FROM ({_Q05_SQL}) q05
"""


@query("q31_name_collisions", _Q31_SQL)
def q31_name_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = q05_sanitize(spark, sf_dir).select("page_id", "file_name")
    counts = names.groupBy("file_name").agg(F.count("*").alias("n_same"))
    return names.join(counts, "file_name").select("page_id", "file_name", "n_same",
                                                 (F.col("n_same") > 1).alias("collides"))


# ---------------------------------------------------------------------------
# q32 filing row projection
# ---------------------------------------------------------------------------

_Q32_SQL = f"""
WITH {OF},
r AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 1 THEN NULL ELSE fecha END AS fecha,
         CASE WHEN o_orderkey % 13 = 2 THEN NULL ELSE emisora END AS emisora, asunto, key,
         CASE o_orderkey % 3 WHEN 0 THEN '/d/' || CAST(o_orderkey AS VARCHAR) WHEN 1 THEN '' END AS pdf_path
  FROM order_filings)
SELECT o_orderkey, {filing_id_sql()} AS filing_id,
       coalesce(emisora, '') AS ticker, coalesce(emisora, '') AS company_name,
       CASE WHEN fecha IS NULL THEN '' ELSE substr(fecha, 7, 4) || '-' || substr(fecha, 4, 2) || '-' || substr(fecha, 1, 2) END AS filing_date,
       asunto AS headline, {classify_sql('asunto')} AS filing_type,
       coalesce(pdf_path <> '', false) AS downloaded, coalesce(pdf_path, '') AS download_path,
       'cnbv' AS source, 'MX' AS country, '' AS filing_time,
       json_extract_string(to_json(struct_pack(fecha := coalesce(fecha, ''), pdf_path := pdf_path)), '$.fecha') AS meta_fecha
FROM r
"""


@query("q32_filing_row", _Q32_SQL)
def q32_filing_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.order_filings(spark, sf_dir)
    k = F.col("o_orderkey")
    src = f.select("o_orderkey",
                   F.when(k % 11 == 1, F.lit(None)).otherwise(F.col("fecha")).alias("fecha"),
                   F.when(k % 13 == 2, F.lit(None)).otherwise(F.col("emisora")).alias("emisora"),
                   "asunto", "key",
                   F.when(k % 3 == 0, F.concat(F.lit("/d/"), k.cast("string"))).when(k % 3 == 1, F.lit(""))
                    .alias("pdf_path"))
    rec = filing_record(src, T0, carry=["o_orderkey"])
    rows = to_filings_rows(rec, T0, None, carry=["o_orderkey"])
    return rows.select("o_orderkey", "filing_id", "ticker", "company_name", "filing_date", "headline",
                       "filing_type", "downloaded", "download_path", "source", "country", "filing_time",
                       F.get_json_object("raw_metadata", "$.fecha").alias("meta_fecha"))


# ---------------------------------------------------------------------------
# q33 lookups and key predicates
# ---------------------------------------------------------------------------

LOOKUP_START = 100
_Q33_SQL = f"""
WITH {OF},
t AS (SELECT CASE WHEN o_orderkey % 17 = 5 THEN 'k' || CAST(o_orderkey AS VARCHAR) ELSE coalesce(key, '') END AS key_text
      FROM order_filings),
n AS (SELECT TRY_CAST(key_text AS BIGINT) AS key FROM t WHERE key_text <> '' AND TRY_CAST(key_text AS BIGINT) IS NOT NULL)
SELECT n.key, 'C' || CAST(n.key AS VARCHAR) AS enc
FROM n
WHERE n.key BETWEEN {LOOKUP_START} AND (SELECT max(o_orderkey) // 2 FROM orders)
  AND n.key % 2 = 0 AND n.key % 10 <> 0
ORDER BY n.key
"""


@query("q33_lookup_range", _Q33_SQL)
def q33_lookup_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.order_filings(spark, sf_dir)
    k = F.col("o_orderkey")
    t = f.select(F.when(k % 17 == 5, F.concat(F.lit("k"), k.cast("string")))
                  .otherwise(F.coalesce(F.col("key"), F.lit(""))).alias("key_text"))
    end = int(fx.read(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]) // 2
    keys = key_range(keyed_rows(t, "key_text", "key").select("key"), "key", LOOKUP_START, end)
    cache = key_range(token_cache_from_orders(spark, sf_dir).select("key", "enc"), "key", LOOKUP_START, end)
    hits = keys.join(cache, "key", "left").filter(truthy(F.col("enc")))
    return hits.orderBy("key").select("key", "enc")


# ---------------------------------------------------------------------------
# q34 download acceptance and file names
# ---------------------------------------------------------------------------

CONTENT_TYPES = ["application/pdf", "application/octet-stream", "text/html; charset=utf-8",
                 "APPLICATION/PDF", "image/png", "application/xhtml+html"]


def _title_sql() -> str:
    pat = "(?is)<title\\b[^>]*>(.*?)</title>"
    return (f"CASE WHEN regexp_matches(html, {lit(pat)}) THEN "
            f"{html_text_sql(f'regexp_extract(html, {lit(pat)}, 1)')} END")


_Q34_SQL = f"""
WITH t AS (
  SELECT page_id, {fx.sql_list(CONTENT_TYPES)}[(page_id % {len(CONTENT_TYPES)}) + 1] AS ct,
         CASE WHEN page_id % 4 = 0 THEN '%PDF-1.4' ELSE '<!DO' END AS head,
         'Doc ' || CAST(page_id AS VARCHAR) || ' é' || CASE WHEN page_id % 5 = 0 THEN '+x' ELSE '' END || '.pdf' AS decoded,
         page_id % 3 AS dmode,
         CASE WHEN page_id % 5 <> 0 THEN coalesce({_title_sql()}, '') || '_p' || CAST(page_id AS VARCHAR) || '.pdf'
              ELSE 'document.pdf' END AS attached
  FROM pages),
a AS (
  SELECT *, contains(lower(ct), 'pdf') OR substr(head, 1, 4) = '%PDF' AS is_pdf,
         contains(ct, 'application/') AND NOT contains(lower(ct), 'html') AS is_file
  FROM t)
SELECT page_id, is_pdf, is_file, is_pdf OR is_file AS accepted, attached,
  CASE WHEN is_pdf OR is_file THEN
    trim(regexp_replace(CASE WHEN dmode = 1 THEN
           CASE WHEN regexp_matches(lower(trim(regexp_replace(attached, '[<>:"/\\\\|?*\\x00-\\x1f]', '_', 'g'), '. ')), '\\.(pdf|xls|xlsx|doc|docx|zip)$')
                THEN trim(regexp_replace(attached, '[<>:"/\\\\|?*\\x00-\\x1f]', '_', 'g'), '. ')
                ELSE trim(regexp_replace(attached, '[<>:"/\\\\|?*\\x00-\\x1f]', '_', 'g'), '. ') || CASE WHEN is_pdf THEN '.pdf' ELSE '.bin' END END
         ELSE decoded END, '[<>:"/\\\\|?*\\x00-\\x1f]', '_', 'g'), '. ')
  END AS file_name
FROM a
"""


@query("q34_download_accept", _Q34_SQL)
def q34_download_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.read(spark, sf_dir, "pages").select("page_id", "html")
    pid = F.col("page_id")
    enc_name = F.concat(F.lit("Doc%20"), pid.cast("string"), F.lit("%20%C3%A9"),
                        F.when(pid % 5 == 0, F.lit("+x")).otherwise(F.lit("")), F.lit(".pdf"))
    disp = (F.when(pid % 3 == 0, F.concat(F.lit('attachment; filename="'), enc_name, F.lit('"')))
             .when(pid % 3 == 1, F.lit(""))
             .otherwise(F.concat(F.lit("inline; filename='"), enc_name, F.lit("'; size=1"))))
    hint = F.when(pid % 5 != 0, name_hint(F.coalesce(title_text("html"), F.lit("")),
                                          F.concat(F.lit("p"), pid.cast("string"))))
    t = p.select("page_id", fx.pick(CONTENT_TYPES, pid % len(CONTENT_TYPES)).alias("ct"),
                 F.when(pid % 4 == 0, F.lit("%PDF-1.4")).otherwise(F.lit("<!DO")).alias("head"),
                 disp.alias("disposition"), attached_name(page_text("html"), hint).alias("attached"))
    a = t.select("*", is_pdf_response("ct", "head").alias("is_pdf"), is_file_response("ct").alias("is_file"))
    acc = F.col("is_pdf") | F.col("is_file")
    return a.select("page_id", "is_pdf", "is_file", acc.alias("accepted"), "attached",
                    F.when(acc, resolve_file_name("disposition", "attached", "is_pdf")).alias("file_name"))


# ---------------------------------------------------------------------------
# q35 paged JSON lists
# ---------------------------------------------------------------------------


def company_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company list pages of 200 customers; near the end one page has a
    non-list ``content`` and the next one is cut (malformed)."""
    c = fx.read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    items = c.select(F.floor(k / PAGE_ITEMS).cast("long").alias("page"), k.alias("pos"),
                     F.when(k % 37 == 5, F.lit(None)).when(k % 41 == 7, F.concat(F.lit("x"), k.cast("string")))
                      .otherwise(k.cast("string")).alias("id"),
                     F.when(k % 43 == 9, F.lit("")).otherwise(F.col("c_name")).alias("clave"))
    pages = items.groupBy("page").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "id", "clave"))),
                    lambda s: F.struct(s["id"].alias("id"), s["clave"].alias("clave"))).alias("content"))
    last = int(items.agg(F.max("page")).first()[0])
    text = (F.when(F.col("page") == last - 3, F.lit('{"content": {"id": "1"}}'))
             .when(F.col("page") == last - 2, F.lit('{"content": [{"id": "1", "clave": "X"}'))
             .otherwise(F.to_json(F.struct("content"))))
    return pages.select("page", text.alias("body"))


_Q35_SQL = f"""
WITH it AS (
  SELECT c_custkey // {PAGE_ITEMS} AS page,
         CASE WHEN c_custkey % 37 = 5 THEN NULL WHEN c_custkey % 41 = 7 THEN 'x' || CAST(c_custkey AS VARCHAR)
              ELSE CAST(c_custkey AS VARCHAR) END AS id,
         CASE WHEN c_custkey % 43 = 9 THEN '' ELSE c_name END AS clave
  FROM customer),
lastp AS (SELECT max(page) AS last FROM it),
cnt AS (SELECT page, CASE WHEN page IN ((SELECT last FROM lastp) - 3, (SELECT last FROM lastp) - 2) THEN 0
                          ELSE count(*) END AS n FROM it GROUP BY page),
stop AS (SELECT min(page) AS stop FROM cnt WHERE n < {PAGE_ITEMS})
SELECT CAST(page AS BIGINT) AS page, CAST(TRY_CAST(id AS BIGINT) AS BIGINT) AS company_id, upper(trim(clave)) AS ticker_key
FROM it
WHERE page <= coalesce((SELECT stop FROM stop), page)
  AND page NOT IN ((SELECT last FROM lastp) - 3, (SELECT last FROM lastp) - 2)
  AND TRY_CAST(id AS BIGINT) IS NOT NULL AND upper(trim(clave)) <> ''
"""


@query("q35_json_pages", _Q35_SQL)
def q35_json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = company_pages(spark, sf_dir)
    rows = company_items(pages, PAGE_ITEMS)
    cid = F.col("id").try_cast("bigint")
    key = F.upper(strip_ws(F.coalesce(F.col("clave"), F.lit(""))))
    return rows.filter(cid.isNotNull() & (key != "")).select("page", cid.alias("company_id"), key.alias("ticker_key"))


# ---------------------------------------------------------------------------
# q36 tallies
# ---------------------------------------------------------------------------

_Q36_SQL = f"""
WITH {OF}
SELECT CAST(count(*) AS BIGINT) AS filings_found,
       CAST(count(*) FILTER (WHERE key IS NOT NULL AND o_orderkey % 3 = 0) AS BIGINT) AS pdfs_downloaded,
       CAST(count(*) - count(*) FILTER (WHERE key IS NOT NULL AND o_orderkey % 3 = 0) AS BIGINT) AS pdfs_failed,
       CAST(count(*) FILTER (WHERE key IS NOT NULL AND o_orderkey % 11 <> 0) AS BIGINT) AS resolved,
       CAST(count(*) FILTER (WHERE NOT (key IS NOT NULL AND o_orderkey % 11 <> 0)) AS BIGINT) AS failed,
       CAST(coalesce(max(TRY_CAST(key AS BIGINT)), 0) AS BIGINT) AS max_key
FROM order_filings
"""


@query("q36_tallies", _Q36_SQL)
def q36_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.order_filings(spark, sf_dir).select("o_orderkey", "key")
    k = F.col("o_orderkey")
    downloads = fx.read(spark, sf_dir, "orders").filter(k % 3 == 0).select(
        k.cast("string").alias("key"), F.concat(F.lit("/pdf/"), k.cast("string"), F.lit(".pdf")).alias("pdf_path"))
    merged = merge_download_status(f, downloads)
    enc = F.when(F.col("key").isNotNull() & (k % 11 != 0), fx.token_of(k))
    merged = merged.withColumn("enc", enc).withColumn("downloads_enabled", F.lit(True))
    # one pass: the tallies' aggregates side by side
    out = merged.agg(*A.run_tally_columns(merged), *A.resolve_tally_columns(), A.max_key_column())
    return A.with_failed_downloads(out, None).select("filings_found", "pdfs_downloaded", "pdfs_failed", "resolved", "failed", "max_key")


# ---------------------------------------------------------------------------
# q37 document pages
# ---------------------------------------------------------------------------

_Q37_SQL = """
WITH n AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS page_no FROM conversations)
SELECT 3 AS max_pages, conv_id, turn, CAST(page_no AS INTEGER) AS page_no FROM n WHERE page_no <= 3
UNION ALL
SELECT 0, conv_id, turn, CAST(page_no AS INTEGER) FROM n
"""


@query("q37_doc_pages", _Q37_SQL)
def q37_doc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fx.read(spark, sf_dir, "conversations").select("conv_id", "turn")
    a = first_pages(c, ["conv_id"], "turn", 3).withColumn("max_pages", F.lit(3))
    b = first_pages(c, ["conv_id"], "turn", 0).withColumn("max_pages", F.lit(0))
    return a.unionByName(b).select("max_pages", "conv_id", "turn", "page_no")


# ---------------------------------------------------------------------------
# q38 encodings
# ---------------------------------------------------------------------------

_Q38_SQL = """
SELECT o_orderkey, CAST(epoch_ms(o_orderdate) AS VARCHAR) AS epoch_ms,
       to_json(struct_pack(period := CAST(o_orderkey % 5 AS VARCHAR), max_pages := CAST(o_orderkey % 7 - 1 AS INTEGER))) AS query_params
FROM orders
"""


@query("q38_encodings", _Q38_SQL)
def q38_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fx.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    return o.select("o_orderkey", epoch_ms_text("o_orderdate").alias("epoch_ms"),
                    to_json_text((k % 5).cast("string").alias("period"),
                                 (k % 7 - 1).cast("int").alias("max_pages")).alias("query_params"))


@query("q38b_base64", "SELECT doc_id, to_base64(encode(text)) AS b64 FROM documents")
def q38b_base64(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    d = fx.read(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", F.base64(F.encode("text", "UTF-8")).alias("b64"))


# ---------------------------------------------------------------------------
# q39 ISIN cache
# ---------------------------------------------------------------------------

@query("q39_isin_cache", _Q10_SQL)
def q39_isin_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = new_run_dir(spark, "isin-cache")
    first = load_isin_map(spark, cache, lambda: q10_isin_build(spark, sf_dir))
    first.count()
    # second call must come from the cache; a builder that fails proves it
    def fail():
        raise RuntimeError("cache miss")
    return load_isin_map(spark, cache, fail).select("ticker_key", "isin")


# ---------------------------------------------------------------------------
# q40 / q41 documents on disk
# ---------------------------------------------------------------------------

_Q40_SQL = f"""
WITH {OF}
SELECT fecha, coalesce(emisora, '') AS emisora, asunto, key FROM order_filings WHERE o_orderkey % 2 = 0
UNION ALL
SELECT fecha, coalesce(emisora, '') AS emisora, asunto, key FROM order_filings WHERE o_orderkey % 2 = 1
"""


def _append_export(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    run = new_run_dir(spark, "append-export")
    f = fx.order_filings(spark, sf_dir)
    rec = filing_record(f.select("fecha", "emisora", "asunto", "key", "o_orderkey"), T0, carry=["o_orderkey"])
    append_filings(rec.filter(F.col("o_orderkey") % 2 == 0).drop("o_orderkey"), f"{run}/monitor")
    append_filings(rec.filter(F.col("o_orderkey") % 2 == 1).drop("o_orderkey"), f"{run}/monitor")
    export_document(spark, f"{run}/monitor", f"{run}/export")
    return run, f"{run}/export"


_Q40B_SQL = f"""
WITH {OF}
SELECT CAST(count(*) AS BIGINT) AS total_filings, CAST(0 AS BIGINT) AS pdfs_downloaded, CAST(count(DISTINCT o_orderkey % 2) AS BIGINT) AS appends FROM order_filings
"""


@query("q40b_append_metadata", _Q40B_SQL)
def q40b_append_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the exported document, which the appends counted."""
    run, dest = _append_export(spark, sf_dir)
    appends = spark.read.json(f"{run}/monitor/metadata").count()
    return read_metadata(spark, dest).select("total_filings", "pdfs_downloaded", F.lit(appends).cast("long").alias("appends"))


@query("q40_append_export", _Q40_SQL)
def q40_append_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dest = _append_export(spark, sf_dir)
    return read_filings_document(spark, dest).select("fecha", "emisora", "asunto", "key")


# the text writer puts one line feed behind each row, so the size is known
_Q41_SQL = "SELECT CAST(sum(strlen(text) + 1) AS BIGINT) AS total_bytes, true AS has_files FROM documents"


@query("q41_dir_size", _Q41_SQL)
def q41_dir_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = new_run_dir(spark, "sizes")
    fx.read(spark, sf_dir, "documents").select("text").write.text(f"{run}/nested/texts")
    return dir_size(spark, run).select("total_bytes", (F.col("n_files") > 0).alias("has_files"))


# ---------------------------------------------------------------------------
# q42 daily counts stream
# ---------------------------------------------------------------------------

# rows of the two middle slices come after the newest event: they are late where
# their day ended a day or more before it
_Q42_SQL = """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n_events
FROM events GROUP BY 1
"""
_Q42B_SQL = """
WITH bnd AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi, max(ts) AS newest FROM events),
cut AS (SELECT CAST(trunc(lo + (hi - lo) / 4.0) AS BIGINT) AS a, CAST(trunc(lo + ((hi - lo) / 4.0) * 3) AS BIGINT) AS z, newest FROM bnd),
e AS (SELECT CAST(ts AS DATE) AS day, epoch_us(ts) >= a AND epoch_us(ts) < z AND CAST(ts AS DATE) + INTERVAL 1 DAY <= newest - INTERVAL 1 DAY AS late FROM events, cut)
SELECT strftime(day, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n_events, CAST(count(*) FILTER (WHERE late) AS BIGINT) AS n_late FROM e GROUP BY 1
"""


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    run = new_run_dir(spark, "daily")
    e = fx.read(spark, sf_dir, "events").select(*EVENT_COLS)
    a, b, c, d = time_slices(e, 4, "ts")
    for drop in (a, d, b, c):  # the last days come second
        write_drop(drop, f"{run}/landing")
        out = run_daily_counts(spark, f"{run}/landing", f"{run}/out", f"{run}/ckpt", e.schema)
    return out


@query("q42_stream_daily", _Q42_SQL)
def q42_stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).select("day", "n_events")


@query("q42b_stream_late", _Q42B_SQL)
def q42b_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day, and those that came after their day was closed."""
    return _daily(spark, sf_dir).select("day", "n_events", "n_late")


# ---------------------------------------------------------------------------
# q43 hidden fields merged with a delta
# ---------------------------------------------------------------------------

_Q43_SQL = """
SELECT o_orderkey, 'a' AS name, CAST(o_orderkey + 1 AS VARCHAR) AS value FROM orders
UNION ALL SELECT o_orderkey, 'b', 'B' || CAST(o_orderkey AS VARCHAR) FROM orders
UNION ALL SELECT o_orderkey, 'c', 'x&y' FROM orders
UNION ALL SELECT o_orderkey, 'd', 'D|' || CAST(o_orderkey AS VARCHAR) FROM orders
UNION ALL SELECT o_orderkey, 'e', '' FROM orders
"""


@query("q43_map_merge", _Q43_SQL)
def q43_map_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    o = fx.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    k = F.col("o_orderkey").cast("string")
    page = F.concat(
        F.lit('<form><input type="hidden" name="a" value="'), k, F.lit('">'),
        F.lit("<input type='hidden' name='b' value='"), F.col("o_custkey").cast("string"), F.lit("'>"),
        F.lit('<INPUT value="'), (F.col("o_orderkey") + 1).cast("string"), F.lit('" TYPE="hidden" name="a">'),
        F.lit('<input type="hidden" id="c" value="x&amp;y"/>'),
        F.lit('<input type="text" name="t" value="no">'),
        F.lit('<input name="e" type="hidden"><input type="submit" name="go" value="Go"></form>'))
    dv = F.concat(F.lit("B"), k)
    dd = F.concat(F.lit("D|"), k)
    delta = F.concat(F.length(dv).cast("string"), F.lit("|hiddenField|b|"), dv, F.lit("|"),
                     F.length(dd).cast("string"), F.lit("|hiddenField|d|"), dd, F.lit("|"))
    merged = delta_hidden_fields(delta, hidden_fields(page))
    return o.select("o_orderkey", F.explode(merged).alias("name", "value"))


# ---------------------------------------------------------------------------
# q44 run age, latest run, schema version
# ---------------------------------------------------------------------------

_Q44_SQL = f"""
WITH {RUNS_SQL}
SELECT id,
  CASE WHEN completed_at IS NULL OR id % 9 = 0 THEN 'inf'::DOUBLE
       ELSE (epoch_us({_AS_OF_SQL}) - epoch_us(completed_ts)) / 3600000000.0 END AS age_hours,
  id = (SELECT max(id) FROM log) AS is_latest,
  3 AS schema_version
FROM log
"""


@query("q44_run_age", _Q44_SQL)
def q44_run_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = events_as_of(spark, sf_dir)
    log = current_log(spark, sf_dir)
    log = log.withColumn("completed_at", F.when(F.col("id") % 9 == 0, F.lit("n/a")).otherwise(F.col("completed_at")))
    latest = latest_row(log.select("id"), "id").first()
    versions = new_run_dir(spark, "schema-version")
    for v in range(1, SCHEMA_VERSION + 1):
        write_schema_version(spark, versions, v)
    # two scalars: the latest id and the stored schema version
    return log.select("id", age_hours(F.col("completed_at"), A._ts(as_of)).alias("age_hours"),
                      (F.col("id") == F.lit(latest["id"] if latest else None)).alias("is_latest"),
                      F.lit(schema_version(spark, versions)).alias("schema_version"))

