"""ISIN map cache.

Our cache is a parquet table (ticker_key, isin), written only when the map
is not empty. The source system's cache format, one JSON object
``{ticker: isin}``, is read where there is no such table: absent, unparsable
or non-object files count as "no cache". Failures that the source system
survives are survived here too, with a warning in the log.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .documents import _exists

MAP_SCHEMA = "ticker_key string, isin string"
log = logging.getLogger(__name__)


def read_json_object_cache(spark: SparkSession, path: str) -> DataFrame | None:
    """A JSON-object cache file -> (ticker_key, isin) rows, or None
    when the file is absent or not a JSON object. Keys are not
    re-normalised (as in the source system)."""
    if not _exists(spark, path):
        return None
    raw = spark.read.text(path, wholetext=True)
    parsed = raw.select(F.from_json("value", "map<string,string>").alias("m"),
                        F.trim("value").startswith("{").alias("is_obj"))
    ok = parsed.filter(F.col("m").isNotNull() & F.col("is_obj"))
    if ok.limit(1).count() == 0:
        return None
    return ok.select(F.explode("m").alias("ticker_key", "isin"))


def write_cache(isin_map: DataFrame, path: str) -> bool:
    """Persist the map; an empty map is never written. Returns whether
    it was written; I/O errors are reported as False, never raised."""
    try:
        if isin_map.isEmpty():
            return False
        isin_map.select("ticker_key", "isin").write.mode("overwrite").parquet(path)
        return True
    except Exception as e:  # noqa: BLE001 - a failed cache write must not stop a run
        log.warning("ISIN map not cached at %s: %s", path, e)
        return False


def read_cache(spark: SparkSession, path: str) -> DataFrame | None:
    """The map cached at ``path``, as our table or as a JSON object; None
    where there is neither."""
    if not _exists(spark, path):
        return None
    if path.endswith(".json"):
        return read_json_object_cache(spark, path)
    try:
        cached = spark.read.schema(MAP_SCHEMA).parquet(path)
        cached.isEmpty()  # reads are lazy: a broken file shows here
        return cached
    except Exception as e:  # noqa: BLE001 - unreadable cache = build again
        log.warning("ISIN cache %s can't be read: %s", path, e)
        return None


def load_isin_map(spark: SparkSession, cache_path: str, build: Callable[[], DataFrame],
                  force_refresh: bool = False, fallback: str | None = None) -> DataFrame:
    """The cached map unless ``force_refresh`` (our cache, else the JSON
    object at ``fallback``); otherwise build it (J5) and cache it when not
    empty. A failed build gives an empty map."""
    for path in () if force_refresh else (cache_path, fallback):
        cached = read_cache(spark, path) if path else None
        if cached is not None:
            return cached
    try:
        built = reliable_checkpoint(build().select("ticker_key", "isin"))  # errors of a lazy build show here
    except Exception as e:  # noqa: BLE001
        log.warning("ISIN map not built: %s", e)
        return spark.createDataFrame([], MAP_SCHEMA)
    if write_cache(built, cache_path):
        return spark.read.schema(MAP_SCHEMA).parquet(cache_path)
    return built
