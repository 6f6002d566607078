"""E5 token-cache build: missing keys -> captured callbacks -> tokens -> upsert.

J2 finds the keys of [start, end] not cached; only their payloads are
parsed (semi join before F14); resolved tokens are upserted (M2) with blank
metadata; misses are not cached and are counted as failed (A8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import token_from_callback
from ..operators.aggregates import resolve_tally_columns
from ..operators.joins import missing_keys
from ..operators.store import TOKEN_CACHE_SCHEMA, evolve, upsert


def resolve_missing(spark: SparkSession, cache: DataFrame, payloads: DataFrame, start: int, end: int,
                    resolved_at: str) -> tuple[DataFrame, DataFrame]:
    """(rows to upsert, tallies) for the keys of [start, end] that the cache
    lacks. ``payloads``: key, body (callback text)."""
    uncached = missing_keys(spark, cache.select("key"), start, end)
    need = payloads.join(uncached, "key", "left_semi")
    tokens = need.select("key", token_from_callback(F.col("body")).alias("enc")).filter(F.col("enc").isNotNull())
    tokens = tokens.groupBy("key").agg(F.max("enc").alias("enc"))
    resolved = uncached.join(tokens, "key", "left")
    fresh = resolved.filter(F.col("enc").isNotNull()).select(
        "key", "enc", *[F.lit("").alias(n) for n in ("emisora", "asunto", "fecha")],
        F.lit(resolved_at).alias("resolved_at"), F.lit(1).alias("_seq"), F.col("key").alias("_pos"))
    tallies = resolved.agg(F.count("*").alias("to_resolve"), *resolve_tally_columns()) \
                      .withColumn("already_cached", F.lit(end - start + 1) - F.col("to_resolve"))
    return fresh, tallies


def build_token_cache(spark: SparkSession, cache: DataFrame, payloads: DataFrame, start: int, end: int,
                      resolved_at: str) -> tuple[DataFrame, DataFrame]:
    """(new cache, tallies)."""
    fresh, tallies = resolve_missing(spark, cache, payloads, start, end, resolved_at)
    return upsert(evolve(cache, TOKEN_CACHE_SCHEMA), fresh, ["key"]), tallies
