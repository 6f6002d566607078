"""ISIN map job: captured JSON list pages -> (ticker_key, isin).

Company pages in order up to the first short one (T6), their items (G6, P11)
and the issues of each company (G6) give the map (J5). Page bodies are parsed
by column expressions; only the number of the stop page reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import take_until_short_page
from ..operators.joins import build_isin_map
from ..operators.parse import json_page_items

COMPANY_ITEM = "struct<id:string,clave:string>"
ISSUE_ITEM = "struct<isin:string,tipoValor:string,serie:string>"
#: items of a full company page
PAGE_ITEMS = 200


def company_items(pages: DataFrame, full: int = PAGE_ITEMS) -> DataFrame:
    """(page, pos, id, clave) of the company pages (page, body) up to and
    including the first with fewer than ``full`` items; malformed pages have none."""
    items = pages.select("page", json_page_items(F.col("body"), COMPANY_ITEM).alias("items"))
    counted = items.select("page", F.size("items").alias("n"), "items")
    taken = take_until_short_page(counted, "page", "n", full)
    return taken.select("page", F.posexplode("items").alias("pos", "it")).select("page", "pos", "it.id", "it.clave")


#: kinds of payload, and what the id of one holds
COMPANY_KIND, ISSUE_KIND = "companies", "issues"
# Fixed value: marker of equity issues.
EQUITY_MARKER = "ACCION"


def isin_map_from_payloads(bronze: DataFrame, marker: str = EQUITY_MARKER, full: int = PAGE_ITEMS) -> DataFrame:
    """The map from captured payloads: company pages have the page number as
    payload id, issue pages ``company/page``."""
    page = F.regexp_extract("payload_id", r"(\d+)$", 1).try_cast("long")
    companies = bronze.filter(F.col("kind") == COMPANY_KIND).select(page.alias("page"), "body")
    issues = bronze.filter(F.col("kind") == ISSUE_KIND).select(F.regexp_extract("payload_id", r"^([^/]+)/", 1).alias("company_id"), page.alias("page"), "body")
    return isin_map_from_pages(companies, issues, marker, full)


def isin_map_from_pages(company_pages: DataFrame, issue_pages: DataFrame, marker: str, full: int = PAGE_ITEMS) -> DataFrame:
    """The map from company pages (page, body) and issue pages (company_id,
    page, body)."""
    companies = company_items(company_pages, full).select(
        F.col("id").alias("company_id"), "clave", F.struct("page", "pos").alias("company_pos"))
    issues = issue_pages.select("company_id", "page", F.posexplode(json_page_items(F.col("body"), ISSUE_ITEM)).alias("pos", "it")).select(
        F.col("company_id").cast("string").try_cast("bigint").alias("company_id"), "it.isin", F.col("it.tipoValor").alias("tipo"),
        F.struct("page", "pos").alias("issue_pos"))
    return build_isin_map(companies, issues, marker)
