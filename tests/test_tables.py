"""Stored tables by linear hashing: growth, pruned lookups, many tasks a bucket."""

import hashlib
import os

from pyspark.sql import functions as F

from filingflow.local_paths import to_local
from filingflow.operators import tables as T
from filingflow.operators.joins import left_join_keyed, new_ids
from filingflow.operators.store import FILINGS_SCHEMA, TOKEN_CACHE_SCHEMA, keep_downloads
from filingflow.session import new_run_dir

BATCH = "key long, enc string, emisora string, asunto string, fecha string, resolved_at string, _seq long, _pos long"


def tokens(spark, keys, tag, seq=1):
    return spark.createDataFrame([(k, hashlib.sha256(f"{tag}{k}".encode()).hexdigest(), "", "", "", "t", seq, i) for i, k in enumerate(keys)], BATCH)


def files_of(table):
    rows = f"{to_local(table)}/rows"
    return {int(b.split("=")[1]): sorted(f for f in os.listdir(f"{rows}/{b}") if f.endswith(".parquet"))
            for b in os.listdir(rows) if b.startswith("bucket=")}


def scanned(df):
    """(result, rows that the file scans gave)."""
    out = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.finalPhysicalPlan().collectLeaves() if "Adaptive" in plan.getClass().getSimpleName() else plan.collectLeaves()
    rows = 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        rows += metric.get().value() if metric.isDefined() and "Scan" in leaves.apply(i).nodeName() else 0
    return out, rows


def test_bucket_numbers():
    """Linear hashing: a table of n buckets uses all of them, growth by one
    splits one, and a chain of splits ends in the same place as one step."""
    assert [T._level(4, n) for n in (4, 5, 7, 8, 9, 16)] == [4, 4, 4, 8, 8, 16]
    assert T.split_buckets(4, 4, 5) == {0} and T.split_buckets(4, 5, 6) == {1} and T.split_buckets(4, 8, 9) == {0}
    assert T.split_buckets(4, 4, 9) == {0, 1, 2, 3}


def test_growth_keeps_rows(spark):
    """From 4 buckets to 64: by the byte bound, then in steps of several sizes."""
    t = f"{new_run_dir(spark, 't-grow')}/t"
    want, shapes = {}, []
    for step in range(3):
        keys = range(step * 700, step * 700 + 900)  # 200 of the step before again
        T.upsert_table(spark, t, TOKEN_CACHE_SCHEMA, tokens(spark, keys, f"s{step}", step), ["key"], buckets=4, bucket_limit=85_000)
        want |= {k: hashlib.sha256(f"s{step}{k}".encode()).hexdigest() for k in keys}
        shapes.append(T.table_buckets(spark, t))

    def check():
        got = T.read_table(spark, t, TOKEN_CACHE_SCHEMA).collect()
        assert {r.key: r.enc for r in got} == want and len(got) == len(want)

    assert 4 <= shapes[0] <= shapes[1] <= shapes[2] and 4 < shapes[2] < 40
    check()
    n = shapes[2]
    for new in (n + 1, 2 * n + 3, 64):
        before = files_of(t)
        T.split_to(spark, t, TOKEN_CACHE_SCHEMA, ["key"], new)
        after = files_of(t)
        # the split buckets are rewritten, no other
        assert {b for b in before if before[b] != after.get(b)} == T.split_buckets(4, n, new) & set(before)
        assert T.table_buckets(spark, t) == new == max(after) + 1
        n = new
        check()
    T.upsert_table(spark, t, TOKEN_CACHE_SCHEMA, tokens(spark, range(5), "z", 9), ["key"])
    want |= {k: hashlib.sha256(f"z{k}".encode()).hexdigest() for k in range(5)}
    check()


def test_rows_left_behind_by_a_split_do_not_count(spark):
    """The old files of a split bucket, put back as after a crash."""
    import shutil
    t = f"{new_run_dir(spark, 't-crash')}/t"
    T.upsert_table(spark, t, TOKEN_CACHE_SCHEMA, tokens(spark, range(300), "a"), ["key"], buckets=4)
    old = to_local(new_run_dir(spark, "t-crash-old"))
    shutil.copytree(f"{to_local(t)}/rows", old)
    T.split_to(spark, t, TOKEN_CACHE_SCHEMA, ["key"], 7)
    shutil.copytree(f"{old}/bucket=0", f"{to_local(t)}/rows/bucket=0", dirs_exist_ok=True)
    # bucket 0 now holds what it kept twice over; of the rest nothing is seen twice
    got = T.read_table(spark, t, TOKEN_CACHE_SCHEMA).groupBy("key").count()
    n = T.table_buckets(spark, t)
    assert {r.key for r in got.filter("count > 1").collect()} == {
        r.key for r in spark.range(300).toDF("key").filter(T.bucket_of(4, n, ["key"]) == 0).collect()}
    T.upsert_table(spark, t, TOKEN_CACHE_SCHEMA, tokens(spark, range(300), "b", 2), ["key"])
    assert T.read_table(spark, t, TOKEN_CACHE_SCHEMA).count() == 300


def test_large_bucket_is_written_by_many_tasks(spark):
    t = f"{new_run_dir(spark, 't-wide')}/t"
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")}
    for k in was:
        spark.conf.set(k, "40k")
    try:
        T.upsert_table(spark, t, TOKEN_CACHE_SCHEMA, tokens(spark, range(12_000), "a"), ["key"], buckets=2)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert min(len(f) for f in files_of(t).values()) >= 4
    assert T.read_table(spark, t, TOKEN_CACHE_SCHEMA).count() == 12_000


def test_lookups_read_touched_buckets(spark):
    t = f"{new_run_dir(spark, 't-probe')}/t"
    schema = FILINGS_SCHEMA
    rows = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("filing_id"), F.col("id"))
    wide = rows.select(*[(F.col("filing_id") if f.name == "filing_id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields],
                       F.lit(1).alias("_seq"), F.col("id").alias("_pos"))
    T.upsert_table(spark, t, schema, wide, ["filing_id"], buckets=16)

    def ids(lo, hi):
        return spark.range(lo, hi).select(F.sha2(F.col("id").cast("string"), 256).alias("filing_id")).persist()

    one = T.lookup_key(spark, t, schema, hashlib.sha256(b"17").hexdigest())
    assert len({f.split("bucket=")[1].split("/")[0] for f in one.inputFiles()}) >= 1
    found, seen = scanned(one.select("filing_id"))
    assert [r.filing_id for r in found] == [hashlib.sha256(b"17").hexdigest()] and 0 < seen < 4000 / 8
    # keys that are not there: the Bloom filters let (nearly) no row group through
    found, seen = scanned(T.probe(spark, t, schema, ids(10_000, 10_003)).select("filing_id"))
    assert not found and seen == 0
    assert T.lookup_key(spark, t, schema, "absent").count() == 0
    # many keys: the join, over their buckets
    many = ids(3000, 5000)
    assert T.probe(spark, t, schema, many).count() == 1000
    assert new_ids(many, T.probe(spark, t, schema, many)).count() == 1000
    assert T.probe(spark, f"{t}-absent", schema, many).count() == 0
    assert T.probe(spark, t, schema, spark.createDataFrame([], "filing_id string")).count() == 0
    assert keep_downloads(T.probe(spark, t, schema, ids(0, 3)), wide.filter("id < 3").drop("id")).count() == 3


def test_marking_touches_its_buckets(spark):
    t = f"{new_run_dir(spark, 't-mark')}/t"
    rows = spark.range(500).select(*[(F.concat(F.lit("f"), F.col("id").cast("string")) if f.name == "filing_id" else F.lit(False) if f.name == "downloaded"
                                      else F.lit(None)).cast(f.dataType).alias(f.name) for f in FILINGS_SCHEMA.fields],
                                   F.lit(1).alias("_seq"), F.col("id").alias("_pos"))
    T.upsert_table(spark, t, FILINGS_SCHEMA, rows, ["filing_id"], buckets=16)
    before = files_of(t)
    marks = spark.createDataFrame([("f3", "/a", 1), ("f3", "/b", 2), ("nobody", "/c", 1)], "filing_id string, download_path string, seq long")
    assert T.mark_downloaded_table(spark, t, marks) == 1
    after = files_of(t)
    assert len([b for b in before if before[b] != after[b]]) == 1
    got = T.read_table(spark, t, FILINGS_SCHEMA)
    assert [(r.filing_id, r.download_path) for r in got.filter("downloaded").collect()] == [("f3", "/b")] and got.count() == 500


def test_keyless_rows_are_joined_once_and_spread(spark):
    left = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"), F.col("id").alias("v"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    left = left.select("k", "m", F.explode(F.array("v")).alias("v"))
    right = spark.range(0, 4000, 6).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    j = left_join_keyed(left, right, "k")
    got = {r.v: r.w for r in j.collect()}
    assert got == {v: (v * 2 if v % 6 == 0 else None) for v in range(4000)} and j.columns == ["k", "m", "v", "w"]
    assert j._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = [r["n"] for r in left_join_keyed(left, right, "k").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(parts) == 8 and max(parts) < 2 * 4000 / 8
