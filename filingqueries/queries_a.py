"""Driver queries q01-q12: functions, parsers and lookups over test tables.

Every query reads whole tables; inputs are derived from them with the same
expression in Spark and in the SQL oracle (see ``fixtures``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.functions.dates import normalize_date
from filingflow.functions.docs import resolve_file_name
from filingflow.functions.text import (classify_filing_type, filing_id, html_text, is_error_page,
                              detail_fields, pager_totals, sanitize_filename, title_text,
                              token_from_callback)
from filingflow.operators.joins import build_isin_map, enrich_isin, left_join_keyed, missing_keys
from filingflow.operators.parse import callback_rows, delta_hidden_fields, delta_rows, grid_rows
from filingflow.session import ensure_conf
from . import fixtures as fx
from .registry import query
from .sqlparts import classify_sql, filing_id_sql, html_text_sql, lit, unescape_sql

OF = fx.ORDER_FILINGS_SQL


# ---------------------------------------------------------------------------
# q01 F1
# ---------------------------------------------------------------------------

def _date_shapes(k, d):
    shape = k % 8
    yyyy = F.date_format(d, "yyyy")
    return (F.when(shape == 0, F.date_format(d, "dd/MM/yyyy"))
             .when(shape == 1, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
             .when(shape == 2, F.when(k % 16 == 2, F.lit(None).cast("string")).otherwise(F.lit("")))
             .when(shape == 3, F.concat(F.lit("order "), k.cast("string")))
             .when(shape == 4, F.date_format(d, "dd/MM/yyyy HH:mm"))
             .when(shape == 5, F.concat(F.lit("99/99/"), yyyy))
             .when(shape == 6, F.concat(F.date_format(d, "dd/MM/"), F.substring(yyyy, 1, 2), F.lit("/"),
                                        F.substring(yyyy, 3, 2)))
             .otherwise(F.date_format(d, "yyyy/MM/dd")))


_Q01_SQL = """
WITH t AS (
  SELECT o_orderkey, o_orderdate AS d, o_orderkey % 8 AS shape,
    CASE o_orderkey % 8
      WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y')
      WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
      WHEN 2 THEN CASE WHEN o_orderkey % 16 = 2 THEN NULL ELSE '' END
      WHEN 3 THEN 'order ' || CAST(o_orderkey AS VARCHAR)
      WHEN 4 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M')
      WHEN 5 THEN '99/99/' || strftime(o_orderdate, '%Y')
      WHEN 6 THEN strftime(o_orderdate, '%d/%m/') || substr(strftime(o_orderdate, '%Y'), 1, 2) || '/'
                  || substr(strftime(o_orderdate, '%Y'), 3, 2)
      ELSE strftime(o_orderdate, '%Y/%m/%d') END AS date_text
  FROM orders)
SELECT o_orderkey, date_text,
  CASE WHEN shape IN (0, 1, 4) THEN strftime(d, '%Y-%m-%d')
       WHEN shape = 5 THEN strftime(d, '%Y') || '-99-99'
       ELSE date_text END AS filing_date
FROM t
"""


@query("q01_normalize_date", _Q01_SQL)
def q01_normalize_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fx.read(spark, sf_dir, "orders")
    t = o.select("o_orderkey", _date_shapes(F.col("o_orderkey"), F.col("o_orderdate")).alias("date_text"))
    return t.select("o_orderkey", "date_text", normalize_date("date_text").alias("filing_date"))


# ---------------------------------------------------------------------------
# q02 / q03 F2
# ---------------------------------------------------------------------------

def _headline_variant(k, base):
    return F.when(k % 3 == 1, F.upper(base)).when(k % 3 == 2, F.lower(base)).otherwise(base)


_H = fx.sql_list(fx.HEADLINES)
_NH = len(fx.HEADLINES)
_Q02_SQL = f"""
WITH t AS (
  SELECT o_orderkey,
    CASE o_orderkey % 3 WHEN 1 THEN upper({_H}[(o_orderkey % {_NH}) + 1])
                        WHEN 2 THEN lower({_H}[(o_orderkey % {_NH}) + 1])
                        ELSE {_H}[(o_orderkey % {_NH}) + 1] END AS headline
  FROM orders)
SELECT o_orderkey, headline, {classify_sql('headline')} AS filing_type FROM t
"""


@query("q02_classify", _Q02_SQL)
def q02_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = fx.read(spark, sf_dir, "orders").select("o_orderkey")
    t = o.select("o_orderkey", _headline_variant(k, fx.pick(fx.HEADLINES, k % _NH)).alias("headline"))
    return t.select("o_orderkey", "headline", classify_filing_type("headline").alias("filing_type"))


_Q03_SQL = f"""
WITH t AS (
  SELECT doc_id, {_H}[(doc_id % {_NH}) + 1] || ' ' || text AS headline FROM documents)
SELECT doc_id, {classify_sql('headline')} AS filing_type FROM t
"""


@query("q03_classify_documents", _Q03_SQL)
def q03_classify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fx.read(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.concat(fx.pick(fx.HEADLINES, F.col("doc_id") % _NH), F.lit(" "), F.col("text"))
    return d.select("doc_id", classify_filing_type(h).alias("filing_type"))


# ---------------------------------------------------------------------------
# q04 F5
# ---------------------------------------------------------------------------

_Q04_SQL = f"""
WITH {OF}
SELECT o_orderkey, {filing_id_sql()} AS filing_id
FROM order_filings
"""


@query("q04_filing_id", _Q04_SQL)
def q04_filing_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.order_filings(spark, sf_dir)
    return f.select("o_orderkey", filing_id("key", "asunto").alias("filing_id"))


# ---------------------------------------------------------------------------
# q05 F3 + F10
# ---------------------------------------------------------------------------

def _last_segment(url):
    return F.regexp_extract(url, r"/([^/?#]*)(?:[?#].*)?$", 1)


_SAN = """trim(regexp_replace({x}, '[<>:"/\\\\|?*\\x00-\\x1f]', '_', 'g'), '. ')"""


def _san_sql(x: str) -> str:
    return _SAN.format(x=x)


_Q05_SQL = f"""
WITH t AS (
  SELECT page_id, url,
         ' .' || regexp_extract(url, '/([^/?#]*)(?:[?#].*)?$', 1) || '?v=' || CAST(page_id % 3 AS VARCHAR) || '. ' AS attached,
         CASE WHEN page_id % 4 = 0 THEN 'attachment; filename="' || regexp_extract(url, '/([^/?#]*)(?:[?#].*)?$', 1) || '.pdf"'
              ELSE '' END AS disposition,
         page_id % 2 = 0 AS is_pdf
  FROM pages),
u AS (
  SELECT *, {_san_sql('attached')} AS base FROM t)
SELECT page_id, {_san_sql('url')} AS safe_url,
  {_san_sql(f'''CASE WHEN disposition <> '' THEN trim(regexp_extract(url, '/([^/?#]*)(?:[?#].*)?$', 1) || '.pdf', '"'' ')
       WHEN lower(base) SIMILAR TO '.*\\.(pdf|xls|xlsx|doc|docx|zip)' THEN base
       WHEN is_pdf THEN base || '.pdf' ELSE base || '.bin' END''')} AS file_name
FROM u
"""


@query("q05_sanitize", _Q05_SQL)
def q05_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.read(spark, sf_dir, "pages").select("page_id", "url")
    seg = _last_segment(F.col("url"))
    t = p.select(
        "page_id", "url",
        F.concat(F.lit(" ."), seg, F.lit("?v="), (F.col("page_id") % 3).cast("string"), F.lit(". ")).alias("attached"),
        F.when(F.col("page_id") % 4 == 0, F.concat(F.lit('attachment; filename="'), seg, F.lit('.pdf"')))
         .otherwise(F.lit("")).alias("disposition"),
        (F.col("page_id") % 2 == 0).alias("is_pdf"))
    return t.select("page_id", sanitize_filename("url").alias("safe_url"),
                    resolve_file_name("disposition", "attached", "is_pdf").alias("file_name"))


# ---------------------------------------------------------------------------
# q06-q08 grid, delta and callback round trips
# ---------------------------------------------------------------------------

def _totals(f: DataFrame) -> tuple[int, int]:
    r = f.agg(F.max("page").alias("p"), F.count("*").alias("n")).first()
    return int(r["p"] or 0), int(r["n"] or 0)


def _grid_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.order_filings(spark, sf_dir)
    pages, rows = _totals(f.select("page"))
    return fx.render_grid_pages(f, pages, rows)


_ROWS_SQL = f"""
WITH {OF}
SELECT page, CAST(pos AS INTEGER) AS pos, fecha, trim(coalesce(emisora, '')) AS emisora, trim(asunto) AS asunto, key{{extra}}
FROM order_filings
"""


@query("q06_grid_roundtrip", _ROWS_SQL.format(
    extra=", CAST(max(page) OVER () AS BIGINT) AS total_pages, CAST(count(*) OVER () AS BIGINT) AS total_rows"))
def q06_grid_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    bronze = _grid_pages(spark, sf_dir)
    tp, tr = pager_totals(F.col("body"))
    rows = grid_rows(bronze.select("page", "body", tp.alias("total_pages"), tr.alias("total_rows")),
                     "body", ["page", "total_pages", "total_rows"])
    return rows.select("page", "pos", "fecha", "emisora", "asunto", "key", "total_pages", "total_rows")


@query("q07_delta_roundtrip", _ROWS_SQL.format(
    extra=", 'vs' || CAST(page AS VARCHAR) || '|x' AS viewstate, 'ev' || CAST(page AS VARCHAR) AS eventvalidation,"
          " 'kept' AS other_field"))
def q07_delta_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    delta = fx.render_delta_pages(_grid_pages(spark, sf_dir))
    old = F.create_map(F.lit("__VIEWSTATE"), F.lit("old"), F.lit("other"), F.lit("kept"))
    fields = delta.select("page", "body", delta_hidden_fields(F.col("body"), old).alias("fields"))
    rows = delta_rows(fields, "body", ["page", "fields"])
    return rows.select("page", "pos", "fecha", "emisora", "asunto", "key",
                       F.col("fields")["__VIEWSTATE"].alias("viewstate"),
                       F.col("fields")["__EVENTVALIDATION"].alias("eventvalidation"),
                       F.col("fields")["other"].alias("other_field"))


_Q08_SQL = f"""
WITH {OF}
SELECT page, CAST(pos AS INTEGER) AS pos, fecha, trim(coalesce(emisora, '')) AS emisora, trim(asunto) AS asunto, key,
  CASE WHEN key IS NULL OR o_orderkey % 11 = 0 THEN NULL ELSE {fx.TOKEN_SQL.format(k='o_orderkey')} END AS enc
FROM order_filings
WHERE NOT (page % 11 = 4 OR page % 13 = 6)
"""


@query("q08_callback_roundtrip", _Q08_SQL)
def q08_callback_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    cb = fx.render_callback_pages(_grid_pages(spark, sf_dir))
    rows = callback_rows(cb, "body", ["page"])
    keyed = fx.order_filings(spark, sf_dir).filter(F.col("key").isNotNull())
    tokens = keyed.select("key", fx.render_token_callback(F.col("o_orderkey")).alias("payload")) \
                  .select("key", token_from_callback("payload").alias("enc"))
    return left_join_keyed(rows, tokens, "key") \
               .select("page", "pos", "fecha", "emisora", "asunto", "key", "enc")


# ---------------------------------------------------------------------------
# q09 page fields
# ---------------------------------------------------------------------------

def _first_tag_text_sql(tag: str) -> str:
    pat = f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}>"
    return (f"CASE WHEN regexp_matches(html, {lit(pat)}) THEN "
            f"{html_text_sql(f'regexp_extract(html, {lit(pat)}, 1)')} END")


_Q09_SQL = f"""
WITH t AS (
  SELECT page_id, html, CASE WHEN page_id % 17 = 5 THEN 404 ELSE 200 END AS http_status,
         {_first_tag_text_sql('title')} AS title, {_first_tag_text_sql('h1')} AS h1
  FROM pages)
SELECT page_id, title, h1,
  CAST(len(regexp_extract_all(html, '(?i)<a[\\s>]')) AS INTEGER) AS n_links,
  coalesce(contains(title, 'Error'), false) OR http_status <> 200 AS rejected,
  CASE WHEN regexp_matches({unescape_sql("regexp_replace(html, '<[^>]*>', '', 'g')")}, 'Emisora:')
       THEN 'present' ELSE '?' END AS emisora
FROM t
"""


@query("q09_page_fields", _Q09_SQL)
def q09_page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.read(spark, sf_dir, "pages").select("page_id", "html")
    status = F.when(F.col("page_id") % 17 == 5, F.lit(404)).otherwise(F.lit(200))
    h1_has = F.col("html").rlike(r"(?is)<h1\b[^>]*>.*?</h1>")
    h1 = F.when(h1_has, html_text(F.regexp_extract("html", r"(?is)<h1\b[^>]*>(.*?)</h1>", 1)))
    det = detail_fields(F.col("html"))
    return p.select(
        "page_id", title_text("html").alias("title"), h1.alias("h1"),
        F.size(F.regexp_extract_all("html", F.lit(r"(?i)<a[\s>]"), 0)).alias("n_links"),
        is_error_page(F.col("html"), status).alias("rejected"),
        F.when(det["emisora"] == "?", F.lit("?")).otherwise(F.lit("present")).alias("emisora"))


# ---------------------------------------------------------------------------
# q10 / q11 ISIN map build and enrichment
# ---------------------------------------------------------------------------

SUPPLIER_MARKER = "PROMO"
CUSTOMER_MARKER = "URGENT"


def supplier_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fx.read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey")
    return s.select(
        F.when(k % 23 == 7, F.concat(F.lit("x"), k.cast("string"))).otherwise(k.cast("string")).alias("company_id"),
        F.when(k % 4 == 0, F.lower(F.concat(F.lit(" n"), F.col("s_nationkey").cast("string"), F.lit(" "))))
         .when(k % 19 == 3, F.lit(""))
         .otherwise(F.col("s_name")).alias("clave"),
        k.alias("company_pos"))


def lineitem_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = fx.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p = fx.read(spark, sf_dir, "part").select("p_partkey", "p_type")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.col("l_suppkey").alias("company_id"),
        F.when(F.col("l_partkey") % 13 == 0, F.lit(" "))
         .otherwise(F.concat(F.lit("MX"), F.lpad(F.col("l_partkey").cast("string"), 10, "0"))).alias("isin"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lower("p_type"), F.lit(" serie")))
         .otherwise(F.concat(F.lit("  "), F.col("p_type"))).alias("tipo"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("issue_pos"))


_Q10_SQL = """
WITH comp AS (
  SELECT TRY_CAST(CASE WHEN s_suppkey % 23 = 7 THEN 'x' || CAST(s_suppkey AS VARCHAR) ELSE CAST(s_suppkey AS VARCHAR) END AS BIGINT) AS company_id,
         upper(trim(CASE WHEN s_suppkey % 4 = 0 THEN lower(' n' || CAST(s_nationkey AS VARCHAR) || ' ')
                         WHEN s_suppkey % 19 = 3 THEN '' ELSE s_name END)) AS ticker_key,
         s_suppkey AS company_pos
  FROM supplier),
iss AS (
  SELECT l_suppkey AS company_id,
         CASE WHEN l_partkey % 13 = 0 THEN ' ' ELSE 'MX' || lpad(CAST(l_partkey AS VARCHAR), 10, '0') END AS isin,
         CASE WHEN l_linenumber % 2 = 0 THEN lower(p_type) || ' serie' ELSE '  ' || p_type END AS tipo,
         l_orderkey, l_linenumber, l_partkey
  FROM lineitem JOIN part ON l_partkey = p_partkey),
q AS (
  SELECT company_id, trim(isin) AS isin,
         row_number() OVER (PARTITION BY company_id ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn
  FROM iss WHERE upper(trim(tipo)) LIKE '%PROMO%' AND trim(isin) <> ''),
pc AS (
  SELECT ticker_key, isin, row_number() OVER (PARTITION BY ticker_key ORDER BY company_pos DESC) AS rn
  FROM comp JOIN q USING (company_id)
  WHERE q.rn = 1 AND comp.company_id IS NOT NULL AND ticker_key <> '')
SELECT ticker_key, isin FROM pc WHERE rn = 1
"""


@query("q10_isin_build", _Q10_SQL)
def q10_isin_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_isin_map(supplier_companies(spark, sf_dir), lineitem_issues(spark, sf_dir), SUPPLIER_MARKER)


def customer_isin_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISIN map with customers as companies and their orders as issues: the
    first '1-URGENT' order of a customer gives its code."""
    c = fx.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("company_id"), F.col("c_name").alias("clave"),
        F.col("c_custkey").alias("company_pos"))
    o = fx.read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("company_id"),
        F.concat(F.lit("MX"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")).alias("isin"),
        F.col("o_orderpriority").alias("tipo"), F.col("o_orderkey").alias("issue_pos"))
    return build_isin_map(c, o, CUSTOMER_MARKER)


CUSTOMER_ISIN_SQL = """
cmap AS (
  SELECT upper(trim(c_name)) AS ticker_key, isin
  FROM (SELECT c_custkey, c_name, 'MX' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS isin,
               row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) AS rn
        FROM customer JOIN orders ON o_custkey = c_custkey
        WHERE upper(trim(o_orderpriority)) LIKE '%URGENT%')
  WHERE rn = 1 AND upper(trim(c_name)) <> '')"""

_Q11_SQL = f"""
WITH {OF}, {CUSTOMER_ISIN_SQL}
SELECT o_orderkey, emisora, cmap.isin AS isin
FROM order_filings LEFT JOIN cmap ON upper(trim(emisora)) = cmap.ticker_key
"""


@query("q11_isin_enrich", _Q11_SQL)
def q11_isin_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.order_filings(spark, sf_dir).select("o_orderkey", "emisora")
    return enrich_isin(f, customer_isin_map(spark, sf_dir)).select("o_orderkey", "emisora", "isin")


# ---------------------------------------------------------------------------
# q12 J2 / U1
# ---------------------------------------------------------------------------

_Q12_SQL = """
SELECT k AS key
FROM (SELECT unnest(range((SELECT min(o_orderkey) FROM orders), (SELECT max(o_orderkey) FROM orders) + 1)) AS k) r
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = r.k)
"""


def order_key_bounds(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    r = fx.read(spark, sf_dir, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return int(r[0]), int(r[1])


def missing_order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo, hi = order_key_bounds(spark, sf_dir)
    cache = fx.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"))
    return missing_keys(spark, cache, lo, hi)


@query("q12_missing_keys", _Q12_SQL)
def q12_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_order_keys(spark, sf_dir)
