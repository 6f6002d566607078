"""Driver queries q45-q48: token-cache build (E5), crawl end to end (E1 with
P9, T3, J8, F9-F13, M1), filings monitor (X1), ISIN job from JSON pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.operators.store import FILINGS_SCHEMA, TOKEN_CACHE_SCHEMA
from filingflow.operators.tables import read_table, upsert_table
from filingflow.session import ensure_conf, new_run_dir, reliable_checkpoint
from filingflow.sources.payloads import BRONZE_SCHEMA, read_payloads
from filingflow.streaming.filings import FilingsPaths, run_filings_monitor
from . import fixtures as fx
from filingflow.plans.cache_build import build_token_cache
from filingflow.plans.crawl import GRID_KINDS, crawl_rows, download_results, parse_payloads, select_rows
from filingflow.plans.isin_build import isin_map_from_pages
from .queries_a import OF, SUPPLIER_MARKER, _Q10_SQL, lineitem_issues, order_key_bounds, supplier_companies
from .queries_b import T1, token_cache_from_orders
from .registry import query
from .sqlparts import classify_sql, filing_id_sql
from filingflow.operators.joins import merge_download_status

_TOK = fx.TOKEN_SQL.format(k="o_orderkey")


def _cache_build(spark: SparkSession, sf_dir: str):
    k = F.col("o_orderkey")
    cache = token_cache_from_orders(spark, sf_dir)
    payloads = (fx.read(spark, sf_dir, "orders").select("o_orderkey").filter(k % 3 != 1)
                  .select(k.alias("key"), fx.render_token_callback(k).alias("body")))
    lo, hi = order_key_bounds(spark, sf_dir)
    return build_token_cache(spark, cache, payloads, lo, hi, T1)


_Q45_SQL = f"""
SELECT o_orderkey AS key,
  CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE 'C' || CAST(o_orderkey AS VARCHAR) END
       ELSE {_TOK} END AS enc,
  CASE WHEN o_orderkey % 2 = 0 THEN '2024-01-01T00:00:00' ELSE '{T1}' END AS resolved_at
FROM orders
WHERE o_orderkey % 2 = 0 OR (o_orderkey % 3 <> 1 AND o_orderkey % 11 <> 0)
"""


@query("q45_cache_build", _Q45_SQL)
def q45_cache_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    new_cache, _ = _cache_build(spark, sf_dir)
    return new_cache.select("key", "enc", "resolved_at")


_Q45B_SQL = """
SELECT CAST(count(*) AS BIGINT) AS to_resolve,
       CAST(count(*) FILTER (WHERE o_orderkey % 3 <> 1 AND o_orderkey % 11 <> 0) AS BIGINT) AS resolved,
       CAST(count(*) FILTER (WHERE NOT (o_orderkey % 3 <> 1 AND o_orderkey % 11 <> 0)) AS BIGINT) AS failed,
       CAST((SELECT count(*) FROM orders) - count(*) AS BIGINT) AS already_cached
FROM orders WHERE o_orderkey % 2 = 1
"""


@query("q45b_cache_tallies", _Q45B_SQL)
def q45b_cache_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tallies = _cache_build(spark, sf_dir)
    return tallies.select("to_resolve", "resolved", "failed", "already_cached")


# ---------------------------------------------------------------------------
# q46 crawl end to end over a stored bronze table
# ---------------------------------------------------------------------------

_CRAWL_AS_OF = "1998-06-30T00:00:00"


def bronze(df: DataFrame, payload_id, kind, body, http_status=None, content_type=None, disposition=None) -> DataFrame:
    """Payload rows in the bronze table's columns."""
    null = F.lit(None).cast("string")
    return df.select(payload_id.cast("string").alias("payload_id"), kind.alias("kind"), F.lit(None).cast("timestamp").alias("captured_at"),
                     (F.lit(200) if http_status is None else http_status).cast("int").alias("http_status"), (null if content_type is None else content_type).alias("content_type"),
                     (null if disposition is None else disposition).alias("content_disposition"), body.alias("body"))


_Q46_SQL = f"""
WITH {OF}
SELECT {filing_id_sql()} AS filing_id, substr(fecha, 7, 4) || '-' || substr(fecha, 4, 2) || '-' || substr(fecha, 1, 2) AS filing_date,
       asunto AS headline, {classify_sql('asunto')} AS filing_type, trim(coalesce(emisora, '')) AS ticker,
       coalesce(TRY_CAST(key AS BIGINT) % 6 = 0, false) AS downloaded,
       CASE WHEN TRY_CAST(key AS BIGINT) % 6 = 0 THEN '/files/doc ' || key || '.pdf' ELSE '' END AS download_path
FROM (SELECT * REPLACE (trim(coalesce(emisora, '')) AS emisora, trim(asunto) AS asunto) FROM order_filings)
WHERE substr(fecha, 7, 4) = '1998'
"""


@query("q46_crawl_e2e", _Q46_SQL)
def q46_crawl_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads stored as a bronze table, parsed, the year of the run kept,
    downloads named and merged, upserted into a stored table."""
    ensure_conf(spark)
    run = new_run_dir(spark, "crawl")
    f = fx.order_filings(spark, sf_dir)
    pages = fx.render_grid_pages(f)
    bronze(pages, F.col("page"), F.col("kind"), F.col("body")).write.parquet(f"{run}/payloads")
    k = F.col("key").cast("bigint")
    files = f.filter(F.col("key").isNotNull() & (k % 3 == 0))
    bronze(files, F.col("key"), F.lit("download"), F.lit("%!"), content_type=F.when(k % 6 == 0, F.lit("application/pdf")).otherwise(F.lit("text/html")),
           disposition=F.concat(F.lit("attachment; filename=\"doc%20"), F.col("key"), F.lit(".pdf\""))).write.mode("append").parquet(f"{run}/payloads")
    grids = read_payloads(spark, f"{run}/payloads", GRID_KINDS)
    # stored: the pages are parsed once, though the rows are used twice
    rows = reliable_checkpoint(select_rows(parse_payloads(grids), grids, _CRAWL_AS_OF, period=3, max_pages=-1))
    rows = merge_download_status(rows, download_results(rows, read_payloads(spark, f"{run}/payloads", ["download", "detail"]), "/files"))
    upsert_table(spark, f"{run}/filings", FILINGS_SCHEMA, crawl_rows(rows, None, _CRAWL_AS_OF, batch_seq=1, keep_order=True), ["filing_id"])
    out = read_table(spark, f"{run}/filings", FILINGS_SCHEMA)
    return out.select("filing_id", "filing_date", "headline", "filing_type", "ticker", "downloaded", "download_path")


# ---------------------------------------------------------------------------
# q47 filings monitor
# ---------------------------------------------------------------------------

_Q47_SQL = f"""
WITH {OF},
b AS (SELECT max(o_orderkey) // 10 AS base FROM orders)
SELECT o_orderkey AS key, {filing_id_sql()} AS filing_id, emisora AS ticker, asunto AS headline,
       substr(fecha, 7, 4) || '-' || substr(fecha, 4, 2) || '-' || substr(fecha, 1, 2) AS filing_date,
       CASE WHEN o_orderkey % 11 <> 0 THEN {fx.TOKEN_SQL.format(k='o_orderkey')} END AS enc
FROM (SELECT * REPLACE (CAST(o_orderkey AS VARCHAR) AS key, CASE WHEN trim(emisora) = '' THEN '?' ELSE trim(emisora) END AS emisora,
                        trim(asunto) AS asunto) FROM order_filings)
WHERE o_orderkey % 17 <> 5 AND o_orderkey % 19 <> 3 AND o_orderkey > (SELECT base FROM b)
"""


@query("q47_monitor_filings", _Q47_SQL)
def q47_monitor_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages and token callbacks of new keys, landing in three drops
    of which the last repeats a tenth; rejected pages (a title with 'Error',
    a status other than 200) give no filing."""
    ensure_conf(spark)
    run = new_run_dir(spark, "filings-monitor")
    paths = FilingsPaths(f"{run}/landing", f"{run}/filings", f"{run}/tokens", f"{run}/state", f"{run}/ckpt")
    f = fx.order_filings(spark, sf_dir)
    k = F.col("o_orderkey")
    title = F.when(k % 17 == 5, F.lit("Error 500")).otherwise(F.lit("Detalle"))
    page = F.concat(F.lit("<html><head><title>"), title, F.lit("</title></head><body><p>Emisora: "), fx.html_escape(F.trim("emisora")),
                    F.lit("</p>\n<p>Asunto : "), fx.html_escape(F.trim("asunto")), F.lit("</p>\n<p>Fecha de recepción: "), F.col("fecha"),
                    F.lit("</p>\n</body></html>"))
    details = bronze(f, k, F.lit("detail"), page, http_status=F.when(k % 19 == 3, 404).otherwise(200))
    # callbacks need the key alone, so no customer is joined
    calls = bronze(fx.read(spark, sf_dir, "orders").select("o_orderkey"), k, F.lit("token_callback"), fx.render_token_callback(k))
    base = order_key_bounds(spark, sf_dir)[1] // 10
    pid = F.col("payload_id").cast("long")
    both = details.unionByName(calls)
    for drop in (both.filter(pid % 2 == 1), both.filter(pid % 2 == 0), both.filter(pid % 10 == 0)):
        drop.write.mode("append").parquet(paths.landing)
        run_filings_monitor(spark, paths, int(base), T1)
    rows = read_table(spark, paths.filings, FILINGS_SCHEMA)
    tokens = read_table(spark, paths.tokens, TOKEN_CACHE_SCHEMA).select("key", "enc")
    key = F.get_json_object("raw_metadata", "$.key").cast("long")
    return rows.withColumn("key", key).join(tokens, "key", "left").select("key", "filing_id", "ticker", "headline", "filing_date", "enc")


# ---------------------------------------------------------------------------
# q48 ISIN job from JSON pages
# ---------------------------------------------------------------------------

@query("q48_isin_pages", _Q10_SQL)
def q48_isin_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company and issue pages as JSON texts, through the whole job."""
    ensure_conf(spark)
    per = 50
    c = supplier_companies(spark, sf_dir)
    content = F.transform(F.array_sort(F.collect_list(F.struct("company_pos", "company_id", "clave"))),
                          lambda s: F.struct(s["company_id"].alias("id"), s["clave"].alias("clave")))
    companies = (c.groupBy(F.floor(F.col("company_pos") / per).cast("long").alias("page")).agg(content.alias("content"))
                  .select("page", F.to_json(F.struct("content")).alias("body")))
    i = lineitem_issues(spark, sf_dir)
    # issues in pages by order number, so a company with many issues is many pages
    listed = F.transform(F.array_sort(F.collect_list(F.struct("issue_pos", "isin", "tipo"))),
                         lambda s: F.struct(s["isin"].alias("isin"), s["tipo"].alias("tipoValor"), F.lit("A").alias("serie")))
    issues = (i.groupBy("company_id", F.floor(F.col("issue_pos.l_orderkey") / 1000).cast("long").alias("page")).agg(listed.alias("content"))
               .select("company_id", "page", F.to_json(F.struct("content")).alias("body")))
    return isin_map_from_pages(companies, issues, SUPPLIER_MARKER, full=per)
