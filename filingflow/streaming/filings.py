"""Filings monitor: captured payloads of new keys -> filings and tokens.

A stream over a landing folder of payloads. Per micro-batch: keys above the
baseline; tokens from callbacks, cached ones first (F14, J3), into the token
cache (M2); accepted detail pages (F17) and their fields (F16) into the
filings table (M1); new keys, high-water mark and cycle (X2, X3). Lookups and
upserts touch the buckets of the batch's keys; upserts replace by key, so a
replayed batch leaves the same tables and counts the same new keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import SOURCE_NAME, is_error_page, labelled_fields, page_text, token_from_callback
from ..operators.joins import resolve_tokens
from ..operators.store import FILING_RECORD_SCHEMA, FILINGS_SCHEMA, TOKEN_CACHE_SCHEMA, to_filings_rows
from ..operators.tables import probe, upsert_table
from ..session import stored
from ..sources.documents import append_filings
from ..sources.payloads import BRONZE_SCHEMA
from .cycles import fresh_keys, record_cycle


@dataclass
class FilingsPaths:
    landing: str
    filings: str
    tokens: str
    state: str
    checkpoint: str
    document: str | None = None     # S4: JSON document of new filings


def batch_tokens(batch: DataFrame, cache: DataFrame) -> DataFrame:
    """J3 for the keys of a batch: key, enc, resolved_from. ``cache`` holds
    the stored rows of those keys."""
    keys = batch.select("key").distinct()
    parsed = (batch.filter(F.col("kind") == "token_callback").select("key", token_from_callback(F.col("body")).alias("enc"))
                   .groupBy("key").agg(F.max("enc").alias("enc")))
    return resolve_tokens(keys, cache, parsed)


def batch_filings(batch: DataFrame, tokens: DataFrame, scraped_at: str) -> DataFrame:
    """Filings rows of the accepted detail pages of a batch. Of several pages
    of a key the last captured counts."""
    pages = batch.filter(F.col("kind") == "detail").filter(~is_error_page(F.col("body"), F.col("http_status")))
    last = pages.groupBy("key").agg(F.max_by("body", F.struct("captured_at", "body")).alias("body"))
    texts = last.select("key", page_text("body").alias("_text"))
    fields = texts.select("key", *[c.alias(n) for n, c in labelled_fields("_text").items()])
    rows = (fields.join(tokens.select("key", "enc"), "key", "left").withColumn("key", F.col("key").cast("string"))
                  .withColumn("pdf_path", F.lit(None).cast("string")).withColumn("scraped_at", F.lit(scraped_at))
                  .withColumn("filing_type", F.lit(None).cast("string")))
    return to_filings_rows(rows, scraped_at, None, carry=["key"])


def sink_filings(batch: DataFrame, batch_id: int, paths: FilingsPaths, as_of: str) -> None:
    s = batch.sparkSession
    batch = batch.persist()
    try:
        cache = probe(s, paths.tokens, TOKEN_CACHE_SCHEMA, batch.select("key"))
        tokens = stored(batch_tokens(batch, cache), "batch-tokens")
        fresh = (tokens.filter(F.col("resolved_from") == "payload")
                       .select("key", "enc", *[F.lit("").alias(n) for n in ("emisora", "asunto", "fecha")],
                               F.lit(as_of).alias("resolved_at"), F.lit(batch_id).alias("_seq"), F.col("key").alias("_pos")))
        upsert_table(s, paths.tokens, TOKEN_CACHE_SCHEMA, fresh, ["key"])
        rows = stored(batch_filings(batch, tokens, as_of).withColumn("_seq", F.lit(batch_id)).withColumn("_pos", F.col("filing_id")), "batch-filings")
        upsert_table(s, paths.filings, FILINGS_SCHEMA, rows.drop("key"), ["filing_id"])
        keyed = rows.select(F.lit(SOURCE_NAME).alias("source"), F.col("key").cast("long").alias("key"), "raw_metadata")
        new = fresh_keys(s, paths.state, keyed, batch_id)
        if paths.document:
            record = F.from_json("raw_metadata", FILING_RECORD_SCHEMA)
            append_filings(keyed.join(new.select("key"), "key", "left_semi").select(record.alias("r")).select("r.*"), paths.document, as_of, f"batch-{batch_id}")
        record_cycle(batch.select(F.lit(SOURCE_NAME).alias("source")), new, paths.state, batch_id, by_source=False)
    finally:
        batch.unpersist()


def run_filings_monitor(spark: SparkSession, paths: FilingsPaths, baseline: int, as_of: str, max_files: int | None = None) -> None:
    """Work off the payloads in the landing folder that no earlier run has
    seen (``availableNow``). ``max_files`` splits a backlog into batches."""
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = (reader.parquet(paths.landing).withColumn("key", F.col("payload_id").try_cast("bigint"))
                    .filter(F.col("key") > F.lit(baseline)))
    q = (stream.writeStream.foreachBatch(lambda batch, batch_id: sink_filings(batch, batch_id, paths, as_of))
               .option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
