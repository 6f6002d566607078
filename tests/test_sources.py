"""Sources, sinks and stored tables (S2-S14, M6, S9) plus E4/E5 plans."""

import io
import json
import os
import zipfile

from pyspark.sql import functions as F

from filingflow.local_paths import to_local
from filingflow.operators.archives import zip_members
from filingflow.operators.filters import lookup, take_until_short_page
from filingflow.operators.store import TOKEN_CACHE_SCHEMA, create_table
from filingflow.operators.tables import read_table, table_buckets, upsert_table
from filingflow.plans.cache_build import build_token_cache
from filingflow.plans.extract import extract_single_file
from filingflow.plans.stats import exit_code_of, stats_text
from filingflow.session import new_run_dir
from filingflow.sources.documents import export_document, read_filings_document
from filingflow.sources.files import dir_size
from filingflow.sources.isin import load_isin_map, read_json_object_cache, write_cache
from filingflow.sources.payloads import read_text_payloads


def test_create_and_upsert_by_bucket(spark):
    d = new_run_dir(spark, "t-tables")
    create_table(spark, f"{d}/cache", TOKEN_CACHE_SCHEMA)
    create_table(spark, f"{d}/cache", TOKEN_CACHE_SCHEMA)  # idempotent
    assert spark.read.parquet(f"{d}/cache").count() == 0
    t = f"{d}/t"
    assert table_buckets(spark, t) is None and read_table(spark, t, TOKEN_CACHE_SCHEMA).count() == 0

    def batch(rows, seq):
        return spark.createDataFrame([(k, e, "", "", "", "t", seq, i) for i, (k, e) in enumerate(rows)],
                                     "key long, enc string, emisora string, asunto string, fecha string, resolved_at string, _seq long, _pos long")

    upsert_table(spark, t, TOKEN_CACHE_SCHEMA, batch([(k, f"a{k}") for k in range(40)], 1), ["key"], buckets=8)
    files = {b: sorted(os.listdir(f"{to_local(t)}/rows/bucket={b}")) for b in range(8)}
    upsert_table(spark, t, TOKEN_CACHE_SCHEMA, batch([(3, "old"), (3, "new"), (3000, "x")], 2), ["key"], buckets=99)
    assert table_buckets(spark, t) == 8  # a table keeps its number
    got = {r.key: r.enc for r in read_table(spark, t, TOKEN_CACHE_SCHEMA).collect()}
    assert got == {**{k: f"a{k}" for k in range(40)}, 3: "new", 3000: "x"}
    same = [b for b in range(8) if sorted(os.listdir(f"{to_local(t)}/rows/bucket={b}")) == files[b]]
    assert len(same) >= 6  # two keys touch two buckets at most
    assert [r.key for r in lookup(read_table(spark, t, TOKEN_CACHE_SCHEMA), "key", 2).collect()] == [2]


def test_json_object_cache(spark):
    d = to_local(new_run_dir(spark, "t-isin"))
    os.makedirs(d)
    for name, text in [("ok.json", json.dumps({"ABC": "MX1", "def": "MX2"})), ("list.json", "[1, 2]"),
                       ("broken.json", "{not json")]:
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    got = {r.ticker_key: r.isin for r in read_json_object_cache(spark, f"{d}/ok.json").collect()}
    assert got == {"ABC": "MX1", "def": "MX2"}  # keys are not re-normalised
    assert read_json_object_cache(spark, f"{d}/list.json") is None
    assert read_json_object_cache(spark, f"{d}/broken.json") is None
    assert read_json_object_cache(spark, f"{d}/absent.json") is None


def test_isin_cache_load(spark):
    d = new_run_dir(spark, "t-isin2")
    empty = spark.createDataFrame([], "ticker_key string, isin string")
    assert write_cache(empty, f"{d}/empty") is False
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([("ABC", "MX1")], "ticker_key string, isin string")

    assert load_isin_map(spark, f"{d}/c", build).count() == 1
    assert load_isin_map(spark, f"{d}/c", build).count() == 1
    assert len(calls) == 1
    load_isin_map(spark, f"{d}/c", build, force_refresh=True)
    assert len(calls) == 2

    def fail():
        raise RuntimeError("portal down")

    assert load_isin_map(spark, f"{d}/other", fail).count() == 0


def test_text_payloads(spark):
    d = to_local(new_run_dir(spark, "t-payloads"))
    os.makedirs(f"{d}/grid")
    with open(f"{d}/grid/p1.html", "w") as fh:
        fh.write("<table>\n<tr class='dxgvDataRow'><td>1</td><td>2</td><td>3</td></tr></table>")
    df = read_text_payloads(spark, d)
    r = df.first()
    assert r.kind == "grid" and r.body.startswith("<table>\n")


def _zip(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, data in members:
            zf.writestr(name, data)
    return buf.getvalue()


def test_zip_members(spark):
    good = _zip([("b.PDF", b"%PDF-1"), ("a.xlsx", b"xx"), ("c.txt", b"t"), ("d/e.png", b"p")])
    rows = [("good", good), ("bad", good[: len(good) // 2]), ("junk", b"not a zip")]
    df = spark.createDataFrame(rows, "archive string, content binary")
    got = [(r.archive, r.member, r.suffix, r.member_pos, r.n_bytes) for r in
           zip_members(df).orderBy("archive", "member_pos").collect()]
    assert got == [("good", "a.xlsx", ".xlsx", 0, 2), ("good", "b.PDF", ".pdf", 1, 6), ("good", "d/e.png", ".png", 2, 1)]


def test_take_until_short_page(spark):
    pages = spark.createDataFrame([(0, 200), (1, 200), (2, 0), (3, 200), (4, 50)], "page int, n int")
    assert [r.page for r in take_until_short_page(pages, "page", "n", 200).orderBy("page").collect()] == [0, 1, 2]


def test_documents_single_file_and_export(spark):
    d = to_local(new_run_dir(spark, "t-docs"))
    os.makedirs(d)
    with open(f"{d}/doc.json", "w") as fh:
        json.dump({"metadata": {"source": "x"}, "filings": [{"fecha": "1", "emisora": "A", "asunto": "s", "key": "9"}]}, fh)
    with open(f"{d}/nofilings.json", "w") as fh:
        json.dump({"metadata": {}}, fh)
    assert [r.key for r in read_filings_document(spark, f"{d}/doc.json").collect()] == ["9"]
    assert read_filings_document(spark, f"{d}/nofilings.json").count() == 0
    assert export_document(spark, f"{d}/absent", f"{d}/out") is None
    sizes = dir_size(spark, d).first()
    assert sizes.n_files == 2 and sizes.total_bytes == os.path.getsize(f"{d}/doc.json") + os.path.getsize(
        f"{d}/nofilings.json")
    assert tuple(dir_size(spark, f"{d}/absent").first()) == (0, 0)


def test_cache_build(spark):
    cache = spark.createDataFrame([(1, "c1", "", "", "", "t0"), (3, "", "", "", "", "t0")], TOKEN_CACHE_SCHEMA)
    payloads = spark.createDataFrame(
        [(2, "/*DX*/<a href=\\\"Detalle.aspx?enc=T2\\\">"), (4, "/*DX*/<div>none<\\/div>"),
         (1, "/*DX*/<a href=\\\"Detalle.aspx?enc=IGNORED\\\">")], "key long, body string")
    new_cache, tallies = build_token_cache(spark, cache, payloads, 1, 5, "t1")
    assert {r.key: r.enc for r in new_cache.collect()} == {1: "c1", 2: "T2", 3: ""}
    t = tallies.first()
    assert (t.to_resolve, t.resolved, t.failed, t.already_cached) == (3, 1, 2, 2)


def test_stats_text_and_codes():
    s = {"total_filings": 3, "downloaded": 1, "pending_download": 2, "unique_companies": 2, "total_crawl_runs": 1,
         "earliest_record": "2026-01-01", "latest_record": "2026-02-01", "db_size_bytes": 10,
         "documents_size_bytes": 0, "health": "degraded"}
    text = stats_text(s)
    assert "Pending download" in text and "degraded" in text
    assert [exit_code_of(h) for h in ("ok", "degraded", "stale", "empty", "error", "?")] == [0, 0, 1, 2, 3, 3]


def test_single_file_extraction(spark):
    d = to_local(new_run_dir(spark, "t-single"))
    os.makedirs(d)
    with open(f"{d}/aviso.pdf", "w") as fh:
        fh.write("Aviso de Oferta Pública de acciones")
    r = extract_single_file(spark, f"{d}/aviso.pdf").first()
    assert r.source.endswith("aviso.pdf") and r.extracted.document_type == "public_offering"


def test_empty_extraction_flag(spark):
    from filingflow.plans.extract import parse_extraction
    texts = ["{}", " { } ", "```json\n{}\n```", "```{}```", "```json {}```", "json {}", '{"a": 1}', "{json}",
             "Sorry", "```json\n{\"a\": {}}\n```"]
    df = spark.createDataFrame([(t,) for t in texts], "model_text string")
    got = [r.extraction_empty for r in parse_extraction(df).collect()]
    assert got == [True, True, True, True, True, True, False, False, False, False]
