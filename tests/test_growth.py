"""Figures that must not grow with the input: plans, batches, files written."""

from __future__ import annotations

import glob
import json
import os

import pandas as pd
from pyspark.sql import functions as F

from filingflow.local_paths import to_local
from filingflow.operators.parse import grid_rows
from filingflow.operators.store import TOKEN_CACHE_SCHEMA
from filingflow.operators.tables import read_table, upsert_table
from filingflow.plans.extract import EXTRACTOR_ROWS, extracted
from filingflow.session import new_run_dir, shared_dir
from filingflow.sources.documents import read_filings_document
from filingflow.sources.json_array import write_array


def _orders(spark, folder: str, n: int) -> str:
    k = F.col("id")
    spark.range(n).select(k.alias("o_orderkey"), (k % 5).alias("o_custkey"), F.to_date(F.lit("1998-02-03")).alias("o_orderdate"),
                          F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{folder}/orders.parquet")
    spark.range(5).select(k.alias("c_custkey"), F.concat(F.lit("Customer "), k.cast("string")).alias("c_name")).write.parquet(f"{folder}/customer.parquet")
    return folder


def test_document_is_one_file_written_without_a_sort(spark):
    """the writer's task sorted the whole table."""
    path = f"{new_run_dir(spark, 'doc')}/doc"
    rows = spark.range(0, 3000, 1, 7).select(F.to_json(F.struct(F.col("id").cast("string").alias("key"))).alias("element"))
    write_array(rows, path, '{"filings": [', "]}")
    files = glob.glob(f"{to_local(path)}/part-*")
    assert len(files) == 1
    with open(files[0]) as f:
        assert sorted(int(x["key"]) for x in json.load(f)["filings"]) == list(range(3000))
    assert read_filings_document(spark, path).count() == 3000
    empty = f"{new_run_dir(spark, 'doc')}/doc"
    write_array(rows.limit(0), empty, '{"filings": [', "]}")
    assert read_filings_document(spark, empty).count() == 0


def test_crawl_parses_its_pages_once(spark, tmp_path, monkeypatch):
    """rows used twice were parsed twice."""
    from filingqueries import queries_d
    seen = []
    real = queries_d.download_results
    monkeypatch.setattr(queries_d, "download_results", lambda rows, *a: seen.append(rows) or real(rows, *a))
    assert queries_d.q46_crawl_e2e(spark, _orders(spark, str(tmp_path), 50)).count() == 50
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "regexp" not in plan


def test_callback_pages_are_dealt_over_many_tasks(spark, tmp_path):
    """pages of little text were parsed by a few large tasks, one more than there are cores."""
    from filingqueries import fixtures as fx
    pages = fx.render_callback_pages(fx.render_grid_pages(fx.order_filings(spark, _orders(spark, str(tmp_path), 400))))
    assert pages.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_cell_fold_asks_each_tag_once(spark):
    """the fold over a nested row's tags ran every regex again for each of its fields."""
    inner = "".join(f"<i>{i}</i>&amp;" for i in range(200))
    row = ('<tr class="dxgvDataRow_A"><td>01/02/1998</td><td><!-- <td> --> A </td><td><table><tr><td title="<td>">' + inner + "</td></tr></table></td></tr>")
    out = grid_rows(spark.createDataFrame([(f"<table>{row}{row}</table>",)], "body string"))
    assert [(r.fecha, r.emisora, r.asunto) for r in out.collect()] == [("01/02/1998", "A", "".join(f"{i}&" for i in range(200)))] * 2
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE (?i)^</td" not in plan and "^\\s+|\\s+$" not in plan


def test_extractor_gets_small_batches(spark):
    """batches of 10,000 documents."""
    def sizes(batches):
        for b in batches:
            yield pd.DataFrame({"source_file": b["source_file"], "model_text": [str(len(b))] * len(b)})

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").cast("string").alias("source_file"), F.lit("x").alias("content"))
    out = extracted(docs, sizes)
    assert out.count() == 3000 and out.agg(F.max(F.col("model_text").cast("int"))).first()[0] <= EXTRACTOR_ROWS
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_upsert_batch_is_stored_compressed(spark):
    """an uncompressed checkpoint of every batch."""
    rows = spark.range(20_000).select(F.col("id").alias("key"), F.lit("x" * 200).alias("enc"), *[F.lit("").alias(n) for n in ("emisora", "asunto", "fecha", "resolved_at")],
                                      F.lit(0).alias("_seq"), F.col("id").alias("_pos"))

    def written() -> int:
        return sum(os.path.getsize(os.path.join(a, f)) for a, _, fs in os.walk(to_local(shared_dir(spark))) for f in fs)

    table, was = f"{new_run_dir(spark, 'tokens')}/t", written()
    upsert_table(spark, table, TOKEN_CACHE_SCHEMA, rows, ["key"])
    assert written() - was < 2 << 20
    assert read_table(spark, table, TOKEN_CACHE_SCHEMA).count() == 20_000
