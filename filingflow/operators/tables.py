"""Stored keyed tables: Parquet folders by hash bucket of the key.

Buckets follow linear hashing. A table is born with n0 buckets and has n now;
with m the largest n0 * 2^k that is at most n, a key's bucket is its hash
modulo 2m if that is below n, else its hash modulo m. Bucket n - m splits next,
into itself and bucket n. An upsert reads and rewrites the buckets of its
batch, then splits as many buckets as the byte bound asks for; no other bucket
is read or written, so a table grows without being rewritten as a whole.

n is read from the folder (its last bucket), so there is no counter that could
disagree with the files. A row counts only in the bucket that its key has: rows
that a split left behind, because it was cut short before the old files went,
are not seen.

Spark's dynamic partition overwrite replaces buckets: rows are staged first,
then each bucket's folder is replaced on commit. It takes no lock. A table has
one writer at a time (the crawl, or the stream's sink); a commit that is cut
short has to be repeated, which upserts may be.

The key column carries Parquet Bloom filters: a lookup of some keys skips row
groups that hold none of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint, stored
from .joins import mark_downloaded
from .store import FILINGS_SCHEMA
from .windows import latest_per_key

#: buckets of a new table
FIRST_BUCKETS = 8
#: a bucket of more bytes splits; splitting goes on until the mean is below the fill
BUCKET_BYTES = 256 << 20
FILL = 0.75
#: up to so many keys are looked up by value (Bloom filters apply), more by a join
PROBE_KEYS = 1000


def _level(first: int, n: int) -> int:
    """The largest first * 2^k that is at most n."""
    m = first
    while 2 * m <= n:
        m *= 2
    return m


def bucket_of(first: int, n: int, key_cols: list[str]) -> Column:
    """The bucket of a key in a table of ``n`` buckets."""
    m, h = _level(first, n), F.xxhash64(*key_cols)
    high = F.pmod(h, F.lit(2 * m))
    return F.when(high < n, high).otherwise(F.pmod(h, F.lit(m))).cast("int")


def split_buckets(first: int, old: int, new: int) -> set[int]:
    """The buckets of a table of ``old`` buckets that growth to ``new`` splits."""
    out = set()
    for b in range(old, new):
        while b >= old:
            b -= _level(first, b)
        out.add(b)
    return out


def _bucket_folders(spark: SparkSession, table_dir: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{table_dir}/rows")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [p.getName() for p in jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(path))]
    return sorted(int(x.split("=")[1]) for x in names if x.startswith("bucket="))


def _drop_bucket(spark: SparkSession, table_dir: str, bucket: int) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{table_dir}/rows/bucket={bucket}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table_shape(spark: SparkSession, table_dir: str) -> tuple[int, int] | None:
    """(buckets at birth, buckets now); None when there is no table."""
    from ..sources.documents import _exists
    if not _exists(spark, f"{table_dir}/_buckets"):
        return None
    first = spark.read.schema("n int").json(f"{table_dir}/_buckets").first()["n"]
    return first, max([first, *(b + 1 for b in _bucket_folders(spark, table_dir))])


def table_buckets(spark: SparkSession, table_dir: str) -> int | None:
    """The number of buckets that a table has (None: no table)."""
    shape = table_shape(spark, table_dir)
    return None if shape is None else shape[1]


def bucket_bytes(spark: SparkSession, table_dir: str) -> dict[int, int]:
    """Bytes of each bucket's files, by a listing that runs in tasks."""
    from ..sources.files import binary_files
    if not _bucket_folders(spark, table_dir):
        return {}
    bucket = F.regexp_extract("path", r"/bucket=(\d+)/[^/]*$", 1).cast("int")
    sizes = binary_files(spark, f"{table_dir}/rows", "*.parquet").select(bucket.alias("bucket"), "length")
    return {r["bucket"]: r["bytes"] for r in sizes.groupBy("bucket").agg(F.sum("length").alias("bytes")).collect()}


def _rows(spark: SparkSession, table_dir: str, schema: T.StructType, key_cols: list[str], shape: tuple[int, int],
          buckets: list[int] | None) -> DataFrame:
    if not _bucket_folders(spark, table_dir):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(f"{table_dir}/rows")
    if buckets is not None:
        rows = rows.filter(F.col("bucket").isin(buckets))
    return rows.filter(F.col("bucket") == bucket_of(*shape, key_cols)).select(*schema.fieldNames())


def key_of(schema: T.StructType) -> list[str]:
    """A table's key: its first column."""
    return [schema.fieldNames()[0]]


def read_table(spark: SparkSession, table_dir: str, schema: T.StructType, buckets: list[int] | None = None,
               key_cols: list[str] | None = None) -> DataFrame:
    """A keyed table, or some of its buckets (partition pruning); an
    absent table is empty."""
    shape = table_shape(spark, table_dir)
    if shape is None:
        return spark.createDataFrame([], schema)
    return _rows(spark, table_dir, schema, key_cols or key_of(schema), shape, buckets)


def lookup_key(spark: SparkSession, table_dir: str, schema: T.StructType, value) -> DataFrame:
    """P5: the rows of one key: its bucket is read, and of that the row groups
    whose Bloom filter lets the key through."""
    key = key_of(schema)[0]
    one = spark.createDataFrame([(value,)], T.StructType([T.StructField(key, schema[key].dataType)]))
    return probe(spark, table_dir, schema, one)


def probe(spark: SparkSession, table_dir: str, schema: T.StructType, keys: DataFrame) -> DataFrame:
    """The stored rows whose key is among ``keys`` (a frame with the key
    column, cheap to read twice). Only the keys' buckets are read; the driver
    sees bucket numbers, and up to ``PROBE_KEYS`` keys."""
    key = key_of(schema)[0]
    shape = table_shape(spark, table_dir)
    if shape is None:
        return spark.createDataFrame([], schema)
    wanted = keys.select(F.col(key).cast(schema[key].dataType).alias(key)).filter(F.col(key).isNotNull()).distinct()
    few = wanted.select(key, bucket_of(*shape, [key]).alias("bucket")).limit(PROBE_KEYS + 1).collect()
    if len(few) <= PROBE_KEYS:
        rows = _rows(spark, table_dir, schema, [key], shape, sorted({r["bucket"] for r in few}))
        return rows.filter(F.col(key).isin([r[key] for r in few]))
    touched = [r["bucket"] for r in wanted.select(bucket_of(*shape, [key]).alias("bucket")).distinct().collect()]
    return _rows(spark, table_dir, schema, [key], shape, touched).join(wanted, key, "left_semi")


def _write(rows: DataFrame, table_dir: str, schema: T.StructType, key_cols: list[str], bucket: Column) -> None:
    """Replace the buckets that ``rows`` have. Rebalancing deals a large bucket
    to several tasks, a file each, and small ones to one."""
    w = (rows.select(*schema.fieldNames(), bucket.alias("bucket")).hint("rebalance", "bucket")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         # filters of 64 KB to 1 MB a row group, the smallest that holds its keys
         .option("parquet.bloom.filter.adaptive.enabled", "true"))
    for k in key_cols:
        w = w.option(f"parquet.bloom.filter.enabled#{k}", "true")
    w.partitionBy("bucket").parquet(f"{table_dir}/rows")


def rewrite_buckets(spark: SparkSession, table_dir: str, schema: T.StructType, key_cols: list[str], changed: DataFrame,
                    merge, buckets: int = FIRST_BUCKETS, bucket_limit: int = BUCKET_BYTES) -> None:
    """Replace the rows of the buckets that ``changed`` (rows with the key
    columns) touches by ``merge(stored rows, changed)``, which keeps every key;
    other buckets keep their files. Then split what has grown beyond
    ``bucket_limit`` bytes. ``buckets`` is the number at birth. The driver sees
    bucket numbers and sizes."""
    shape = table_shape(spark, table_dir)
    if shape is None:
        shape = buckets, buckets
        spark.range(1).select(F.lit(buckets).alias("n")).write.mode("overwrite").json(f"{table_dir}/_buckets")
    bucket = bucket_of(*shape, key_cols)
    touched = [r["bucket"] for r in changed.select(bucket.alias("bucket")).distinct().collect()]
    if touched:
        _write(merge(_rows(spark, table_dir, schema, key_cols, shape, touched), changed), table_dir, schema, key_cols, bucket)
        grow(spark, table_dir, schema, key_cols, bucket_limit)


def grow(spark: SparkSession, table_dir: str, schema: T.StructType, key_cols: list[str], bucket_limit: int = BUCKET_BYTES) -> int:
    """Split buckets, in order, while one is above ``bucket_limit`` bytes; the
    number of buckets then. A split reads the old bucket and writes it and the
    new ones."""
    first, n = table_shape(spark, table_dir)
    sizes = bucket_bytes(spark, table_dir)
    m = _level(first, n)
    over = [b for b, size in sizes.items() if size > bucket_limit]
    if not over:
        return n
    # enough for the mean, and for the turn of every large bucket that waits for its own
    new = max([n + 1, -(-sum(sizes.values()) // int(FILL * bucket_limit)), *(b + m + 1 for b in over if n - m <= b < m)])
    split_to(spark, table_dir, schema, key_cols, new)
    return new


def split_to(spark: SparkSession, table_dir: str, schema: T.StructType, key_cols: list[str], new: int) -> None:
    """Grow a table to ``new`` buckets, reading and writing the split ones only."""
    first, n = table_shape(spark, table_dir)
    split = split_buckets(first, n, new)
    rows = reliable_checkpoint(_rows(spark, table_dir, schema, key_cols, (first, n), sorted(split)))
    bucket = bucket_of(first, new, key_cols)
    filled = {r["bucket"] for r in rows.select(bucket.alias("bucket")).distinct().collect()}
    _write(rows, table_dir, schema, key_cols, bucket)
    for b in sorted(split - filled):
        _drop_bucket(spark, table_dir, b)  # all of its rows went to new buckets


def upsert_table(spark: SparkSession, table_dir: str, schema: T.StructType, batch: DataFrame, key_cols: list[str],
                 order_cols: tuple[str, ...] = ("_seq", "_pos"), buckets: int = FIRST_BUCKETS, bucket_limit: int = BUCKET_BYTES) -> None:
    """M1/M2 on a stored table: only the batch's buckets move."""
    cols = schema.fieldNames()
    latest = latest_per_key(batch.withColumn("_seq", F.col("_seq").cast("long")).select(*cols, *order_cols), key_cols, list(order_cols))
    # as Parquet: a checkpoint holds the same rows uncompressed
    latest = stored(latest.select(*cols), "upsert-batch")
    rewrite_buckets(spark, table_dir, schema, key_cols, latest,
                    lambda old, new: old.join(new.select(*key_cols), key_cols, "left_anti").unionByName(new), buckets, bucket_limit)


def mark_downloaded_table(spark: SparkSession, table_dir: str, updates: DataFrame) -> int:
    """M3 on the stored filings table: ``updates`` (filing_id, download_path,
    seq) touch only their buckets; unknown ids are ignored. The number of rows
    marked."""
    updates = reliable_checkpoint(updates)
    known = reliable_checkpoint(updates.join(probe(spark, table_dir, FILINGS_SCHEMA, updates).select("filing_id"), "filing_id", "left_semi"))
    rewrite_buckets(spark, table_dir, FILINGS_SCHEMA, ["filing_id"], known, mark_downloaded)
    return known.select("filing_id").distinct().count()
