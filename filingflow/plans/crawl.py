"""E1 crawl plan: captured payloads -> filings rows.

bronze (payload_id, kind, body) -> G1/G2/G3 by kind -> records (P1) ->
F2 classify -> J1 enrich (broadcast only if the map is proven small) ->
P3 filings rows -> M1 upsert (one shuffle on filing_id). Everything is one
logical plan; Catalyst prunes the bronze columns and AQE sizes the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import normalize_date
from ..functions.docs import attached_name, is_file_response, is_pdf_response, name_hint, resolve_file_name
from ..functions.text import page_text
from ..operators.filters import filter_by_period, limit_pages
from ..operators.joins import enrich_isin
from ..operators.parse import callback_rows, delta_rows, grid_rows
from ..operators.store import to_filings_rows, upsert
from ..operators.windows import global_row_number

GRID_KINDS = ["grid", "delta", "grid_callback"]


def parse_payloads(bronze: DataFrame, id_col: str = "payload_id") -> DataFrame:
    """Rows of every grid-bearing payload, dispatched by ``kind``:
    'grid' (HTML), 'delta' (async update), 'grid_callback' (script callback).
    Output: payload id, pos, fecha, emisora, asunto, key."""
    keep = [id_col]
    g = grid_rows(bronze.filter(F.col("kind") == "grid"), "body", keep)
    d = delta_rows(bronze.filter(F.col("kind") == "delta"), "body", keep)
    c = callback_rows(bronze.filter(F.col("kind") == "grid_callback"), "body", keep)
    return g.unionByName(d).unionByName(c)


def payload_order(id_col: str = "payload_id") -> list[Column]:
    """Crawl order: numeric payload ids numerically, others by text."""
    text = F.col(id_col).cast("string")
    return [F.coalesce(text.try_cast("long"), F.lit(-1)), text]


def select_rows(rows: DataFrame, bronze: DataFrame, as_of: str, period: int = 0, max_pages: int = -1,
                id_col: str = "payload_id") -> DataFrame:
    """Rows of the first ``max_pages`` payloads (in crawl order,
    ending before the first without rows) whose date lies in ``period``."""
    if max_pages >= 0:
        number, text = payload_order(id_col)
        pages = global_row_number(bronze.select(id_col).distinct().select(id_col, number.alias("_n"), text.alias("_t")), ["_n", "_t"], "_page")
        pages = pages.select(id_col, "_page")
        rows = limit_pages(rows.join(pages, id_col), "_page", max_pages, pages.count()).drop("_page")
    if period:
        rows = filter_by_period(rows.withColumn("_date", normalize_date(F.col("fecha"))), "_date", period, as_of[:10]).drop("_date")
    return rows


def download_results(rows: DataFrame, downloads: DataFrame, folder: str) -> DataFrame:
    """(key, pdf_path) of the accepted downloads. ``downloads`` are
    payloads of kind 'download' (payload_id is the key, body the first part
    of the file); a 'detail' payload of the key may name the file."""
    d = downloads.filter(F.col("kind") == "download").select(F.col("payload_id").alias("key"), "content_type", "content_disposition", "body")
    detail = downloads.filter(F.col("kind") == "detail").select(F.col("payload_id").alias("key"), page_text(F.col("body")).alias("_text"))
    named = rows.filter(F.col("key").isNotNull()).groupBy("key").agg(F.min(F.struct("emisora", "asunto")).alias("_r"))
    j = d.join(named, "key").join(detail, "key", "left")
    is_pdf = is_pdf_response(F.col("content_type"), F.col("body"))
    attached = attached_name(F.coalesce(F.col("_text"), F.lit("")), name_hint(F.col("_r.emisora"), F.col("_r.asunto")))
    name = resolve_file_name(F.col("content_disposition"), attached, is_pdf)
    return (j.filter(is_pdf | is_file_response(F.col("content_type")))
             .select("key", F.concat(F.lit(folder.rstrip("/") + "/"), name).alias("pdf_path"))
             .groupBy("key").agg(F.min("pdf_path").alias("pdf_path")))


def crawl(bronze: DataFrame, isin_map: DataFrame | None, scraped_at: str,
          id_col: str = "payload_id", existing: DataFrame | None = None,
          batch_seq: int = 0, map_is_table: bool = True) -> DataFrame:
    """Filings rows of one crawl; with ``existing`` the result is the
    upserted table (last write wins per filing_id, payload order kept)."""
    return crawl_rows(parse_payloads(bronze, id_col), isin_map, scraped_at, id_col, existing, batch_seq,
                      map_is_table)


def crawl_rows(rows: DataFrame, isin_map: DataFrame | None, scraped_at: str, id_col: str = "payload_id",
               existing: DataFrame | None = None, batch_seq: int = 0, map_is_table: bool = True,
               keep_order: bool = False) -> DataFrame:
    """The crawl after parsing: enrich, classify, filings rows, upsert."""
    rec = rows
    if isin_map is not None:
        rec = enrich_isin(rec, isin_map, "emisora", "isin", materialize=not map_is_table)
    else:
        rec = rec.withColumn("isin", F.lit(None).cast("string"))
    rec = (rec.withColumn("enc", F.lit(None).cast("string"))
              .withColumn("pdf_path", (F.col("pdf_path") if "pdf_path" in rows.columns else F.lit(None)).cast("string"))
              .withColumn("filing_type", F.lit(None).cast("string"))
              .withColumn("scraped_at", F.lit(scraped_at))
              .withColumn("_seq", F.lit(batch_seq).cast("long"))
              # crawl order, then row position
              .withColumn("_pos", F.struct(*payload_order(id_col), F.col("pos"))))
    if existing is None:
        return to_filings_rows(rec, created_at=scraped_at, isin_col="isin",
                               carry=["_seq", "_pos"] if keep_order else None)
    batch = to_filings_rows(rec, created_at=scraped_at, isin_col="isin", carry=["_seq", "_pos"])
    return upsert(existing, batch, ["filing_id"])
