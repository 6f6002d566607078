"""Filings documents on disk.

The source system keeps one JSON document ``{metadata, filings: [...]}`` and
rewrites it whole on every append. Here a document is a directory:
``filings/`` holds JSON lines (splittable, appended as new files) and
``metadata/`` a counter row per write or append, which the writes count
themselves; reading the metadata adds the rows up. A
single-file document in the source format can be read too, by many tasks
(``json_array``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import truthy
from ..operators.store import FILING_RECORD_SCHEMA
from .json_array import read_array


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


COUNTERS = "source string, scraped_at string, total_filings long, pdfs_downloaded long, pdfs_failed long, last_updated string"


def _write_counted(filings: DataFrame, folder: str, mode: str) -> tuple[int, int]:
    """Write rows as JSON lines; (rows, rows with a document), counted by the
    write itself."""
    seen = Observation()
    ok = truthy(F.col("pdf_path")) if "pdf_path" in filings.columns else F.lit(False)
    filings.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("documents")).write.mode(mode).json(folder)
    counts = seen.get
    return counts["rows"], counts["documents"]


def _add_counters(spark: SparkSession, folder: str, mode: str, row: tuple) -> None:
    spark.createDataFrame([row], COUNTERS).coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(folder)


def write_filings_document(filings: DataFrame, path: str, source: str, scraped_at: str,
                           downloads_enabled: bool = False, mode: str = "errorifexists") -> None:
    """S3: filings as JSON lines plus a counter row (source, scraped_at,
    total_filings, pdfs_downloaded, pdfs_failed)."""
    rows, done = _write_counted(filings, f"{path}/filings", mode)
    _add_counters(filings.sparkSession, f"{path}/metadata", mode, (source, scraped_at, rows, done, rows - done if downloads_enabled else 0, None))


def append_filings(filings: DataFrame, path: str, last_updated: str | None = None, append_id: str | None = None) -> None:
    """Append without de-duplication as new files, with a counter row of
    this append; nothing stored is read. With an ``append_id`` a repeated
    append replaces itself."""
    folder, mode = (f"/{append_id}", "overwrite") if append_id else ("", "append")
    spark = filings.sparkSession
    first = read_metadata(spark, path)
    failing = first is not None and (first.first()["pdfs_failed"] or 0) > 0
    rows, done = _write_counted(filings, f"{path}/filings{folder}", mode)
    _add_counters(spark, f"{path}/metadata{folder}", mode, (None, None, rows, done, rows - done if failing else 0, last_updated))


def read_metadata(spark: SparkSession, path: str) -> DataFrame | None:
    """The metadata of a document directory, one row folded from its counter
    rows (None when there is none)."""
    if not _exists(spark, f"{path}/metadata"):
        return None
    rows = spark.read.schema(COUNTERS).option("recursiveFileLookup", True).json(f"{path}/metadata")
    return rows.agg(F.max("source").alias("source"), F.max("scraped_at").alias("scraped_at"),
                    *[F.sum(n).alias(n) for n in ("total_filings", "pdfs_downloaded", "pdfs_failed")], F.max("last_updated").alias("last_updated"))


def read_filings_document(spark: SparkSession, path: str,
                          schema: T.StructType | None = None) -> DataFrame:
    """The filings of a document directory, or of a single JSON document
    in the source format (``filings`` array, empty when absent)."""
    schema = schema or FILING_RECORD_SCHEMA
    if _exists(spark, f"{path}/filings"):
        return spark.read.schema(schema).option("recursiveFileLookup", True).json(f"{path}/filings")
    return read_array(spark, path, "filings").select(F.from_json("element", schema).alias("f")).select("f.*")


def export_document(spark: SparkSession, src: str, dest: str, files: int | None = None) -> DataFrame | None:
    """Copy a document, all columns of its rows and its metadata, to
    another path; an absent source writes nothing and returns None (a warning
    in the source system)."""
    if not _exists(spark, src):
        return None
    rows = spark.read.option("recursiveFileLookup", True).json(f"{src}/filings") if _exists(spark, f"{src}/filings") else read_filings_document(spark, src)
    (rows.coalesce(files) if files else rows).write.mode("overwrite").json(f"{dest}/filings")
    meta = read_metadata(spark, src)
    if meta is not None:
        meta.write.mode("overwrite").json(f"{dest}/metadata")
    return rows


def write_extracted(docs: DataFrame, path: str, model: str) -> None:
    """Extracted documents plus metadata {model, total_processed}."""
    docs.write.mode("errorifexists").json(f"{path}/documents")
    docs.agg(F.count("*").alias("total_processed")) \
        .select(F.lit(model).alias("model"), "total_processed") \
        .coalesce(1).write.mode("errorifexists").json(f"{path}/metadata")
