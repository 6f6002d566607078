"""Join operators.

Joins carry no broadcast hints: statistics and AQE pick the strategy from the
sizes met at run time. Left joins carry a salt in the join key that spreads
rows without a key; hot keys are split by AQE's skew join, which may cut the
left side of a left join anywhere. Anti joins pre-aggregate the right side
(distinct keys) so that duplicate keys are combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import has_equity_marker, strip_ws, ticker_key, truthy
from ..session import reliable_checkpoint


#: parts that left rows without a key are dealt into
KEYLESS_PARTS = 256


def left_join_keyed(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer equi-join on ``key`` that reads ``left`` once. Rows without a
    key match nothing; a salt of their content, part of the join key, deals
    them over ``KEYLESS_PARTS`` values, so they don't meet in one task. The
    right side has salt 0, as keyed rows have: it is not copied. (It is computed
    from the key; a literal would be folded out of the join key.) The salt is a
    hash, not a row number, so a repeated task deals its rows alike."""
    # maps can't be hashed; such rows are dealt by their other columns
    dealt_by = [F.col(f"`{f.name}`") for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*dealt_by), F.lit(KEYLESS_PARTS))).otherwise(zero)
    extra = [c for c in right.columns if c != key]
    joined = left.withColumn("_salt", salt).join(right.withColumn("_salt", zero), [key, "_salt"], "left")
    return joined.select(*left.columns, *extra)


def enrich_isin(filings: DataFrame, isin_map: DataFrame, emisora_col: str = "emisora",
                out_col: str = "isin", materialize: bool = True) -> DataFrame:
    """Left outer equi-join on the normalised issuer (F4); null when the
    issuer is blank or absent from the map. ``isin_map`` has (ticker_key, isin)
    with one row per key. A map that is computed (not a stored table) is
    checkpointed first, so it is built once."""
    m = isin_map.select(F.col("ticker_key").alias("_tk"), F.col("isin").alias(out_col))
    if materialize:
        m = reliable_checkpoint(m)
    return left_join_keyed(filings.withColumn("_tk", ticker_key(F.col(emisora_col))), m, "_tk").drop("_tk")


def missing_keys(spark: SparkSession, cached_keys: DataFrame, start: int, end: int,
                 key_col: str = "key", partitions: int | None = None) -> DataFrame:
    """Integers in [start, end] not in the cache, as a distributed
    range anti-joined with the (distinct) cached keys of that range (P6)."""
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rng = spark.range(start, end + 1, 1, numPartitions=max(1, n)).withColumnRenamed("id", key_col)
    cached = (cached_keys.select(F.col(key_col).cast("bigint").alias(key_col))
                         .filter(F.col(key_col).between(start, end)).distinct())
    return rng.join(cached, key_col, "left_anti")


def resolve_tokens(keys: DataFrame, cache: DataFrame, payload_tokens: DataFrame,
                   key_col: str = "key") -> DataFrame:
    """Cache-first token resolution. A truthy cached token wins, else the
    token parsed from the key's callback payload; misses stay null.
    Output: key, enc, resolved_from ('cache' | 'payload' | null)."""
    # one shuffle per side on the key: both joins share the keys' partitioning
    j = (keys.join(cache.select(F.col(key_col), F.col("enc").alias("_cenc")), key_col, "left")
             .join(payload_tokens.select(F.col(key_col), F.col("enc").alias("_penc")), key_col, "left"))
    hit = truthy("_cenc")
    return j.select(
        key_col,
        F.when(hit, F.col("_cenc")).otherwise(F.col("_penc")).alias("enc"),
        F.when(hit, F.lit("cache")).when(F.col("_penc").isNotNull(), F.lit("payload")).alias("resolved_from"))


def new_ids(batch: DataFrame, existing: DataFrame, id_col: str = "filing_id") -> DataFrame:
    """Distinct ids of a batch that are not stored yet."""
    return batch.select(id_col).distinct().join(existing.select(id_col), id_col, "left_anti")


def build_isin_map(companies: DataFrame, issues: DataFrame, marker: str) -> DataFrame:
    """Per company, the first issue (by ``issue_pos``) whose type
    contains the marker and whose isin is not blank; companies without one
    are dropped; key = upper(strip(clave)); a later company (by
    ``company_pos``) wins a duplicate key. Companies with a missing or
    non-integer id or a blank key are skipped (P11).

    companies: company_id (string/any), clave, company_pos
    issues:    company_id (long), isin, tipo, issue_pos (orderable)
    Both picks are aggregates (min_by / max_by) with map-side partial
    aggregation, so a company holding many issues is combined before the
    shuffle."""
    comp = (companies
            .select(F.col("company_id").cast("string").try_cast("bigint").alias("company_id"),
                    F.upper(strip_ws(F.coalesce(F.col("clave").cast("string"), F.lit("")))).alias("ticker_key"),
                    "company_pos")
            .filter(F.col("company_id").isNotNull() & (F.col("ticker_key") != "")))
    first_issue = (issues.filter(has_equity_marker(F.col("tipo"), F.col("isin"), marker))
                         .groupBy("company_id")
                         .agg(F.min_by(strip_ws(F.col("isin")), F.col("issue_pos")).alias("isin")))
    per_company = comp.join(first_issue, "company_id", "inner")
    return (per_company.groupBy("ticker_key")
                       .agg(F.max_by("isin", "company_pos").alias("isin")))


def mark_downloaded(filings: DataFrame, updates: DataFrame, id_col: str = "filing_id") -> DataFrame:
    """Set downloaded/download_path for ids in ``updates``
    (filing_id, download_path; last one per id wins by ``seq``); unknown ids
    are ignored."""
    u = (updates.groupBy(id_col)
                .agg(F.max_by("download_path", "seq").alias("_path")))
    j = filings.join(u, id_col, "left")
    hit = F.col("_path").isNotNull()
    return (j.withColumn("downloaded", F.when(hit, F.lit(True)).otherwise(F.col("downloaded")))
             .withColumn("download_path", F.when(hit, F.col("_path")).otherwise(F.col("download_path")))
             .drop("_path"))


def merge_download_status(filings: DataFrame, downloads: DataFrame, key_col: str = "key") -> DataFrame:
    """Download results merged by key (never by position)."""
    return left_join_keyed(filings, downloads.select(key_col, "pdf_path"), key_col)
