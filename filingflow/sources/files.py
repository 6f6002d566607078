"""File-system sources: binary files and directory sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def binary_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Recursive ``binaryFile`` scan (path, modificationTime, length, content)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def dir_size(spark: SparkSession, path: str) -> DataFrame:
    """Number of files and total bytes under a directory; an absent
    directory gives zeros. Only ``length`` is read: the content column is
    pruned from the scan."""
    from .documents import _exists
    if not _exists(spark, path):
        return spark.range(1).select(F.lit(0).cast("bigint").alias("n_files"),
                                     F.lit(0).cast("bigint").alias("total_bytes"))
    files = binary_files(spark, path).select("length")
    return files.agg(F.count("*").alias("n_files"),
                     F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("total_bytes"))
