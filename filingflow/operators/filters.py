"""Row filters: period windows (P9), page limits (T3), key predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import missing_keys

# Fixed value: the look-back of period 2.
RECENT_DAYS = 180


def _as_date(c):
    return F.try_to_date(c, "yyyy-MM-dd")


def filter_by_period(df: DataFrame, date_col: str, period: int, as_of: str) -> DataFrame:
    """0 all, 1 latest date present, 2 last 180 days up to ``as_of``,
    3 the year of ``as_of``, 4 ``as_of`` itself. Dates are ISO strings;
    strings that are not dates never match periods 2-4."""
    d = _as_date(F.col(date_col))
    a = dt.date.fromisoformat(as_of)
    if period == 0:
        return df
    if period == 1:
        latest = df.agg(F.max(date_col).alias("_latest"))
        # one-row aggregate as the build side of a semi join
        return df.join(F.broadcast(latest), F.col(date_col) == F.col("_latest"), "left_semi")
    if period == 2:
        return df.filter(d.between(F.lit(a - dt.timedelta(days=RECENT_DAYS)), F.lit(a)))
    if period == 3:
        return df.filter(F.year(d) == a.year)
    if period == 4:
        return df.filter(d == F.lit(a))
    raise ValueError(f"unknown period {period}")


def effective_max_pages(max_pages: int) -> int | None:
    """0 and 1 both mean the first page; -1 means all (None: no bound)."""
    return None if max_pages < 0 else max(1, max_pages)


def limit_pages(rows: DataFrame, page_col: str, max_pages: int, total_pages: int) -> DataFrame:
    """Pages up to min(max_pages, total), stopping before the first
    page (1..total) that has no rows. The first empty page is found with a
    distributed range anti-join over page numbers (no page list on the
    driver); only its number comes back."""
    spark = rows.sparkSession
    most = effective_max_pages(max_pages)
    limit = total_pages if most is None else min(most, total_pages)
    empty = missing_keys(spark, rows.select(F.col(page_col).alias("key")), 1, max(1, total_pages))
    first_empty = empty.agg(F.min("key")).first()[0]
    cond = F.col(page_col) <= F.lit(limit)
    if first_empty is not None:
        cond = cond & (F.col(page_col) < F.lit(int(first_empty)))
    return rows.filter(cond)


def keyed_rows(df: DataFrame, key_col: str = "key", out_col: str = "key_num") -> DataFrame:
    """Rows with a non-empty key that is an integer."""
    k = F.col(key_col)
    return (df.filter(k.isNotNull() & (k != ""))
              .withColumn(out_col, k.try_cast("bigint"))
              .filter(F.col(out_col).isNotNull()))


def key_range(df: DataFrame, key_col: str, start: int, end: int) -> DataFrame:
    """Inclusive key range (pushed down to the parquet scan)."""
    return df.filter(F.col(key_col).between(start, end))


def lookup(df: DataFrame, key_col: str, value) -> DataFrame:
    """P5: rows of one key (pushed to the parquet scan as an equality)."""
    return df.filter(F.col(key_col) == F.lit(value))


def take_until_short_page(pages: DataFrame, page_col: str, count_col: str, full: int) -> DataFrame:
    """Pages in order up to and including the first one with fewer than
    ``full`` items (failed or malformed pages count 0). Only the stop page
    number reaches the driver."""
    stop = pages.filter(F.col(count_col) < full).agg(F.min(page_col)).first()[0]
    return pages if stop is None else pages.filter(F.col(page_col) <= F.lit(stop))
