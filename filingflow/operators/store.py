"""Keyed tables: schemas, records, upserts, crawl log, evolution (M1-M7).

Parquet has no primary key and no row-level update; the key is kept by the
operators: an upsert picks the last write per key inside the batch, drops
the replaced keys from the stored rows with an anti-join and appends the
batch. ``tables`` does so on stored tables. The crawl log is event-sourced:
start and completion events are appended, the current log is starts
left-joined with the latest completion per id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import duration_seconds, iso_text, normalize_date
from ..functions.docs import to_json_text
from ..functions.text import COUNTRY, SOURCE_NAME, classify_filing_type, filing_id, truthy
from ..session import reliable_checkpoint
from .windows import latest_per_key

# The tables' columns.
S = T.StringType()
FILINGS_SCHEMA = T.StructType([
    T.StructField("filing_id", S, False), T.StructField("source", S), T.StructField("country", S),
    T.StructField("ticker", S), T.StructField("isin", S), T.StructField("company_name", S),
    T.StructField("filing_date", S), T.StructField("filing_time", S), T.StructField("headline", S),
    T.StructField("filing_type", S), T.StructField("category", S), T.StructField("document_url", S),
    T.StructField("direct_download_url", S), T.StructField("file_size", S),
    T.StructField("num_pages", T.IntegerType()), T.StructField("price_sensitive", T.BooleanType()),
    T.StructField("downloaded", T.BooleanType()), T.StructField("download_path", S),
    T.StructField("raw_metadata", S), T.StructField("created_at", S),
])
TOKEN_CACHE_SCHEMA = T.StructType([
    T.StructField("key", T.LongType(), False), T.StructField("enc", S, False),
    T.StructField("emisora", S), T.StructField("asunto", S), T.StructField("fecha", S),
    T.StructField("resolved_at", S),
])
CRAWL_LOG_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False), T.StructField("crawl_type", S, False),
    T.StructField("source", S), T.StructField("query_params", S),
    T.StructField("filings_found", T.IntegerType()), T.StructField("filings_new", T.IntegerType()),
    T.StructField("pages_crawled", T.IntegerType()), T.StructField("errors", S),
    T.StructField("started_at", S, False), T.StructField("completed_at", S),
    T.StructField("duration_seconds", T.DoubleType()),
])
FILING_RECORD_SCHEMA = T.StructType([
    T.StructField(n, S) for n in ("fecha", "emisora", "asunto", "key", "enc", "pdf_path",
                                  "filing_type", "scraped_at")
])

# Defaults of the filings columns added by migrations.
FILINGS_DEFAULTS: dict[str, object] = {
    "source": SOURCE_NAME, "country": COUNTRY, "filing_type": "other",
    "price_sensitive": False, "downloaded": False,
}
SCHEMA_VERSION = 3


# ---------------------------------------------------------------------------
# M6 / M7
# ---------------------------------------------------------------------------

def create_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """M6: create an empty table if absent (idempotent)."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def write_schema_version(spark: SparkSession, path: str, version: int) -> None:
    """Record a schema version (one row per migration run)."""
    spark.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(path)


def schema_version(spark: SparkSession, path: str) -> int:
    """The largest recorded version, 0 when there is none."""
    from ..sources.documents import _exists
    if not _exists(spark, path):
        return 0
    return spark.read.schema("version int").parquet(path).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def evolve(df: DataFrame, target: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """M7: add missing columns with typed defaults (null when none), cast
    present ones, return columns in target order. Idempotent."""
    defaults = defaults or {}
    have = set(df.columns)
    cols = []
    for f in target.fields:
        if f.name in have:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Records -> filings rows
# ---------------------------------------------------------------------------

def filing_record(df: DataFrame, scraped_at: str, carry: list[str] | None = None) -> DataFrame:
    """Dict -> record with defaults ('' for the three texts, null for the
    optional ones, ``scraped_at`` given)."""
    have = set(df.columns)

    def c(n: str, default: Column) -> Column:
        return F.coalesce(F.col(n), default) if n in have else default

    return df.select(
        c("fecha", F.lit("")).alias("fecha"), c("emisora", F.lit("")).alias("emisora"),
        c("asunto", F.lit("")).alias("asunto"),
        *[(F.col(n) if n in have else F.lit(None)).cast("string").alias(n)
          for n in ("key", "enc", "pdf_path", "filing_type")],
        c("scraped_at", F.lit(scraped_at)).alias("scraped_at"), *(carry or []))


def record_json(df: DataFrame) -> Column:
    """Record -> JSON text in the fixed column order, nulls kept."""
    return to_json_text(*[F.col(n) for n in FILING_RECORD_SCHEMA.fieldNames()])


def to_filings_rows(records: DataFrame, created_at: str, isin_col: str | None = "isin",
                    carry: list[str] | None = None) -> DataFrame:
    """Record -> ``filings`` row. ticker and company_name are the raw
    issuer; headline the subject; downloaded = truthy path; download_path =
    path or ''; constant source/country; other texts ''; filing_time unset;
    date normalised (F1); type from the record or classified (F2)."""
    have = set(records.columns)
    ftype = F.coalesce(F.col("filing_type"), classify_filing_type(F.col("asunto"))) \
        if "filing_type" in have else classify_filing_type(F.col("asunto"))
    # the record is serialised after classification, as the source does
    records = records.withColumn("filing_type", ftype)
    for n in FILING_RECORD_SCHEMA.fieldNames():
        if n not in have and n != "filing_type":
            records = records.withColumn(n, F.lit(None).cast("string"))
    return records.select(
        filing_id("key", "asunto", "fecha", "emisora").alias("filing_id"),
        F.lit(SOURCE_NAME).alias("source"), F.lit(COUNTRY).alias("country"),
        F.coalesce(F.col("emisora"), F.lit("")).alias("ticker"),
        (F.col(isin_col) if isin_col and isin_col in have else F.lit(None)).cast("string").alias("isin"),
        F.coalesce(F.col("emisora"), F.lit("")).alias("company_name"),
        normalize_date(F.coalesce(F.col("fecha"), F.lit(""))).alias("filing_date"),
        F.lit("").alias("filing_time"),
        F.coalesce(F.col("asunto"), F.lit("")).alias("headline"),
        F.col("filing_type"),
        F.lit("").alias("category"), F.lit("").alias("document_url"),
        F.lit("").alias("direct_download_url"), F.lit("").alias("file_size"),
        F.lit(None).cast("int").alias("num_pages"), F.lit(False).alias("price_sensitive"),
        truthy(F.col("pdf_path")).alias("downloaded"),
        F.coalesce(F.col("pdf_path"), F.lit("")).alias("download_path"),
        record_json(records).alias("raw_metadata"),
        F.lit(created_at).alias("created_at"),
        *(carry or []),
    )


# ---------------------------------------------------------------------------
# M1 / M2: upserts
# ---------------------------------------------------------------------------

def upsert(existing: DataFrame, batch: DataFrame, key_cols: list[str],
           order_cols: list[str] = ("_seq", "_pos")) -> DataFrame:
    """Full-row replace by key; inside a batch the last row wins.

    ``batch`` carries ``_seq`` (batch number) and ``_pos`` (position in the
    batch). Only the batch is shuffled (to pick its last write per key); the
    stored table is filtered with an anti-join on the batch keys -- a
    broadcast when the batch is proven small -- and is never re-shuffled, so
    a small crawl does not move the whole table."""
    cols = list(existing.columns)
    b = batch.withColumn("_seq", F.col("_seq").cast("long"))  # _pos: any orderable column
    latest = reliable_checkpoint(latest_per_key(b.select(*cols, *order_cols), key_cols, list(order_cols)))
    kept = existing.join(latest.select(*key_cols), key_cols, "left_anti")
    return kept.unionByName(latest.select(*cols))


def keep_downloads(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """The batch with stored download fields where it has no document itself
    (without this a re-crawl resets them, as in the source system). The
    lookup joins only the batch's keys."""
    prev = (existing.filter(F.col("downloaded")).select("filing_id", F.col("download_path").alias("_prev_path"))
                    .join(batch.select("filing_id").distinct(), "filing_id", "left_semi"))
    b = batch.join(prev, "filing_id", "left").withColumn(
        "_keep", ~F.coalesce(F.col("downloaded"), F.lit(False)) & F.col("_prev_path").isNotNull())
    return (b.withColumn("downloaded", F.when(F.col("_keep"), F.lit(True)).otherwise(F.col("downloaded")))
             .withColumn("download_path", F.when(F.col("_keep"), F.col("_prev_path")).otherwise(F.col("download_path")))
             .drop("_prev_path", "_keep"))


def upsert_filings(existing: DataFrame, batch: DataFrame, mode: str = "replace") -> DataFrame:
    """M1 for filings rows. ``replace`` (parity): a later batch row replaces
    the stored row whole. ``preserve``: see ``keep_downloads``."""
    if mode not in ("replace", "preserve"):
        raise ValueError(f"unknown mode {mode}")
    return upsert(existing, keep_downloads(existing, batch) if mode == "preserve" else batch, ["filing_id"])


# ---------------------------------------------------------------------------
# M4 / M5: event-sourced crawl log
# ---------------------------------------------------------------------------

def crawl_log(starts: DataFrame, completions: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Current crawl log: start events (id, crawl_type, query_params,
    started_at) left-joined with the latest completion per id (id, seq,
    filings_found, filings_new, pages_crawled, errors, completed_ts).
    Completions for unknown ids are ignored; duration from F20."""
    latest = (completions.groupBy("id")
                         .agg(F.max_by(F.struct("filings_found", "filings_new", "pages_crawled",
                                                "errors", "completed_ts"), "seq").alias("c")))
    j = starts.join(latest, "id", "left")
    done = F.col("c").isNotNull()
    return j.select(
        F.col("id").cast("long"), "crawl_type", F.lit(SOURCE_NAME).alias("source"), "query_params",
        F.when(done, F.col("c.filings_found")).otherwise(0).cast("int").alias("filings_found"),
        F.when(done, F.col("c.filings_new")).otherwise(0).cast("int").alias("filings_new"),
        F.when(done, F.col("c.pages_crawled")).otherwise(0).cast("int").alias("pages_crawled"),
        F.col("c.errors").alias("errors"),
        "started_at",
        iso_text(F.col("c.completed_ts")).alias("completed_at"),
        duration_seconds(F.col("started_at"), F.col("c.completed_ts")).alias("duration_seconds"),
        *(carry or []),
    )
