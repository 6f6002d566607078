"""Captured payloads (S1): the bronze table the parsers read.

Bronze schema: payload_id, kind, captured_at, http_status, content_type,
content_disposition, body. Payloads come either as a parquet table or as
one text file per payload (kind given, or taken from the folder name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BRONZE_SCHEMA = ("payload_id string, kind string, captured_at timestamp, http_status int, "
                 "content_type string, content_disposition string, body string")


def read_payloads(spark: SparkSession, path: str, kinds: list[str] | None = None) -> DataFrame:
    """Bronze parquet table; ``kinds`` filters are pushed to the scan."""
    df = spark.read.schema(BRONZE_SCHEMA).parquet(path)
    return df.filter(F.col("kind").isin(kinds)) if kinds else df


def read_text_payloads(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """One payload per file (``wholetext``): id = file path; kind given or the
    name of the file's parent folder."""
    # wholetext must be the method argument: text() would reset the option
    raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    src = F.input_file_name()
    k = F.lit(kind) if kind else F.regexp_extract(src, r"/([^/]+)/[^/]+$", 1)
    return raw.select(src.alias("payload_id"), k.alias("kind"), F.lit(None).cast("timestamp").alias("captured_at"),
                      F.lit(200).alias("http_status"), F.lit(None).cast("string").alias("content_type"),
                      F.lit(None).cast("string").alias("content_disposition"), F.col("value").alias("body"))
