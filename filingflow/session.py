"""Session helpers: one place for the SQL settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings the library needs. They can be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # hidden-field maps: a later duplicate name wins (parity with dict updates)
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # lists of keys reach Parquet's Bloom filters as values, not as a range
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # base64 text without MIME line breaks (as Python's b64encode)
    "spark.sql.chunkBase64String.enabled": "false",
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: int):
    """Within it, jobs hand at most so many rows or bytes to Python at once."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    was = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


_SHIPPED: set[tuple[int, str]] = set()


def ship_package(spark: SparkSession, folder: str | None = None) -> None:
    """Make a package (this one, or the one in ``folder``) importable in Python
    workers (what ``--py-files`` does): zip it once per SparkContext and
    ``addPyFile`` it. Needed by the operators that run Python in tasks."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: ship with --py-files instead
        return
    pkg = os.path.abspath(folder or os.path.dirname(__file__))
    key = (id(sc._jsc), pkg)
    if key in _SHIPPED:
        return
    import zipfile
    name = os.path.basename(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix=f"{name}-pyfiles-"), f"{name}.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def get_spark(master: str | None = None, app: str = "filingflow",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session. Cluster settings come from spark-submit;
    the defaults below only matter for local runs and tests."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.driver.memory", os.environ.get("FF_DRIVER_MEMORY", "8g")))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_conf(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator (HDFS/S3/...). Only when it is
    unset (local runs, tests) do we create one, and register it so that
    ``DataFrame.checkpoint()`` uses the same place.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the folder
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        if sc is None or not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="filingflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one run's files."""
    base = shared_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df):
    """Cut lineage with a reliable checkpoint in the shared folder (never a
    local checkpoint): recomputation after an executor loss reads the
    written data instead of re-running upstream stages."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """Write ``df`` as Parquet into the shared folder and read it again: the
    lineage ends there, and a lost executor costs a read, not a recomputation."""
    spark = df.sparkSession
    path = new_run_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
