"""End to end through the command line: crawl twice, stats, export."""

import json

from pyspark.sql import functions as F

from filingflow import cli
from filingqueries import fixtures as fx
from filingflow.session import new_run_dir

SF = "/root/testdata/sf0.001"


def test_crawl_stats_export(spark, capsys):
    run = new_run_dir(spark, "test-cli")
    f = fx.order_filings(spark, SF)
    bronze = fx.render_grid_pages(f, 75, 1500).select(
        F.col("page").cast("string").alias("payload_id"), "kind", F.lit(None).cast("timestamp").alias("captured_at"),
        F.lit(200).alias("http_status"), F.lit(None).cast("string").alias("content_type"),
        F.lit(None).cast("string").alias("content_disposition"), "body")
    bronze.write.parquet(f"{run}/payloads")
    args = ["crawl", "--payloads", f"{run}/payloads", "--filings", f"{run}/filings", "--log", f"{run}/log",
            "--as-of", "2026-02-01T00:00:00", "--period", "0", "--max-pages", "-1", "--json-out", f"{run}/json"]
    assert cli.main(args, spark) == 0
    assert cli.main(args[:7] + ["--as-of", "2026-02-02T00:00:00", "--period", "0", "--max-pages", "-1"], spark) == 0
    capsys.readouterr()
    code = cli.main(["stats", "--filings", f"{run}/filings", "--log", f"{run}/log", "--docs", f"{run}/none",
                     "--as-of", "2026-02-02T06:00:00", "--json"], spark)
    s = json.loads(capsys.readouterr().out)
    assert s["total_filings"] == 1500  # key-less filings with like headlines stay apart
    assert s["total_crawl_runs"] == 2 and s["health"] == "ok" and code == 0
    assert s["db_size_bytes"] > 0 and s["documents_size_bytes"] == 0
    log = cli.read_log(spark, f"{run}/log").orderBy("id").collect()
    assert len(log) == 2 and log[0].id < log[1].id
    assert log[0].started_at == "2026-02-01T00:00:00" and 0 < log[0].duration_seconds < 600
    assert log[0].filings_new == s["total_filings"] and log[1].filings_new == 0
    assert json.loads(log[0].query_params) == {"period": 0, "max_pages": -1}
    code = cli.main(["stats", "--filings", f"{run}/filings", "--log", f"{run}/log", "--docs", f"{run}/none",
                     "--as-of", "2026-02-09T00:00:00"], spark)
    assert code == 1 and "stale" in capsys.readouterr().out
    assert cli.main(["export", "--src", f"{run}/json", "--dest", f"{run}/exported"], spark) == 0
    assert spark.read.json(f"{run}/exported/filings").count() == 1500


def test_monitor_command(spark):
    import datetime as dt
    from filingflow.streaming.monitor import write_drop
    run = new_run_dir(spark, "test-cli-monitor")
    ev = spark.createDataFrame([(i, dt.datetime(2026, 4, 1) + dt.timedelta(minutes=7 * i)) for i in range(1, 301)],
                               "key long, ts timestamp_ntz")
    write_drop(ev, f"{run}/landing")
    args = ["monitor", "--landing", f"{run}/landing", "--out", f"{run}/out", "--start-key", "250", "--once"]
    assert cli.main(args, spark) == 0
    keys = sorted(r.key for r in spark.read.parquet(f"{run}/out/sink").collect())
    assert keys == list(range(251, 301))
    # restarting with nothing new adds nothing
    assert cli.main(args, spark) == 0
    assert spark.read.parquet(f"{run}/out/sink").count() == 50
    assert cli.main(["monitor", "--landing", f"{run}/landing", "--out", f"{run}/fresh", "--once"], spark) == 1


def test_cache_and_extract_commands(spark, capsys):
    import os
    from filingflow.local_paths import to_local
    run = new_run_dir(spark, "test-cli-cache")
    rows = [(str(k), "token_callback", None, 200, None, None,
             f"/*DX*/<a href=\\\"Detalle.aspx?enc=T{k}\\\">" if k % 2 else "/*DX*/<p>none<\\/p>")
            for k in range(1, 11)] + [("bad-id", "token_callback", None, 200, None, None, "/*DX*/")]
    spark.createDataFrame(rows, "payload_id string, kind string, captured_at timestamp, http_status int, "
                                "content_type string, content_disposition string, body string") \
         .write.parquet(f"{run}/payloads")
    assert cli.main(["cache", "--payloads", f"{run}/payloads", "--cache", f"{run}/cache", "--start", "1",
                     "--end", "10", "--as-of", "2026-01-01T00:00:00"], spark) == 0
    t = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (t["resolved"], t["failed"], t["already_cached"]) == (5, 5, 0)
    docs = to_local(f"{run}/docs")
    os.makedirs(docs)
    for name, text in [("a.txt", "Informe anual de la emisora"), ("b.txt", "Aviso de dividendo")]:
        with open(f"{docs}/{name}", "w") as fh:
            fh.write(text)
    spark.createDataFrame([("1", f"{docs}/a.txt"), ("2", f"{docs}/b.txt"), ("3", "")], "key string, pdf_path string") \
         .write.json(f"{run}/filings/filings")
    assert cli.main(["extract", "--filings", f"{run}/filings", "--documents", f"{run}/docs",
                     "--out", f"{run}/extracted"], spark) == 0
    got = {r["filing"]["key"]: r["extracted"]["document_type"]
           for r in spark.read.json(f"{run}/extracted/documents").collect()}
    assert got == {"1": "annual_report", "2": "dividend"}


def test_empty_crawl_is_degraded(spark, capsys):
    run = new_run_dir(spark, "test-cli-empty")
    spark.createDataFrame([("1", "grid", None, 200, None, None, "<html>no grid</html>")],
                          "payload_id string, kind string, captured_at timestamp, http_status int, "
                          "content_type string, content_disposition string, body string").write.parquet(f"{run}/p")
    assert cli.main(["crawl", "--payloads", f"{run}/p", "--filings", f"{run}/f", "--log", f"{run}/l",
                     "--as-of", "2026-03-01T00:00:00"], spark) == 1
    capsys.readouterr()
    code = cli.main(["stats", "--filings", f"{run}/f", "--log", f"{run}/l", "--docs", f"{run}/d",
                     "--as-of", "2026-03-01T01:00:00", "--json"], spark)
    s = json.loads(capsys.readouterr().out)
    assert (s["health"], s["total_filings"], s["total_crawl_runs"], code) == ("degraded", 0, 1, 0)
    log = cli.read_log(spark, f"{run}/l").first()
    assert log.errors == "No filings found" and log.filings_found == 0


BRONZE = ("payload_id string, kind string, captured_at timestamp, http_status int, content_type string, "
          "content_disposition string, body string")


def _payloads(spark, keys):
    page = ("<html><head><title>{t}</title></head><body><p>Emisora: E{k}</p>\n<p>Asunto: Aviso {k}</p>\n"
            "<p>Fecha de recepción: 0{d}/02/2026</p>\n</body></html>")
    rows = [(str(k), "detail", None, 404 if k % 5 == 0 else 200, None, None, page.format(k=k, t="Detalle", d=k % 9 + 1)) for k in keys]
    rows += [(str(k), "token_callback", None, 200, None, None, f"/*DX*/<a href=\\\"Detalle.aspx?enc=T{k}\\\">") for k in keys]
    return spark.createDataFrame(rows, BRONZE)


def test_monitor_command_on_payloads(spark):
    """Payloads become tokens, filings and a JSON document; a second run adds
    what has landed since; marking sets download fields."""
    from filingflow.operators.store import FILINGS_SCHEMA, TOKEN_CACHE_SCHEMA
    from filingflow.operators.tables import read_table
    from filingflow.sources.documents import read_filings_document, read_metadata
    from filingflow.streaming.cycles import burst_log
    run = new_run_dir(spark, "test-cli-payloads")
    args = ["monitor", "--landing", f"{run}/landing", "--out", f"{run}/out", "--json-out", f"{run}/doc", "--start-key", "2",
            "--as-of", "2026-02-01T00:00:00", "--once"]
    for keys in (range(1, 11), range(8, 14)):
        _payloads(spark, keys).write.mode("append").parquet(f"{run}/landing")
        assert cli.main(args, spark) == 0
    want = [k for k in range(3, 14) if k % 5]
    filings = read_table(spark, f"{run}/out/filings", FILINGS_SCHEMA)
    assert sorted(r.headline for r in filings.collect()) == sorted(f"Aviso {k}" for k in want)
    assert {r.key: r.enc for r in read_table(spark, f"{run}/out/tokens", TOKEN_CACHE_SCHEMA).collect()} == {k: f"T{k}" for k in range(3, 14)}
    assert sorted(int(r.key) for r in read_filings_document(spark, f"{run}/doc").collect()) == want
    assert read_metadata(spark, f"{run}/doc").first()["total_filings"] == len(want)
    log = {r.batch_id: (r.new_count, r.last_key, r["mode"]) for r in burst_log(spark, f"{run}/out/state").collect()}
    assert log == {0: (6, 9, "burst"), 1: (3, 13, "normal")}
    first = filings.filter("headline = 'Aviso 3'").first()["filing_id"]
    spark.createDataFrame([(first, "/d/a.pdf", 1), ("nobody", "/x", 1)], "filing_id string, download_path string, seq long").write.parquet(f"{run}/marks")
    assert cli.main(["mark", "--filings", f"{run}/out/filings", "--updates", f"{run}/marks"], spark) == 0
    marked = read_table(spark, f"{run}/out/filings", FILINGS_SCHEMA).filter("downloaded").collect()
    assert [(r.filing_id, r.download_path) for r in marked] == [(first, "/d/a.pdf")]


def test_isin_command(spark, capsys):
    import os
    from filingflow.local_paths import to_local
    from filingflow.sources.isin import read_cache
    run = new_run_dir(spark, "test-cli-isin")
    rows = [("0", "companies", json.dumps({"content": [{"id": 1, "clave": " abc "}, {"id": 2, "clave": "DEF"}]})),
            ("1/0", "issues", json.dumps({"content": [{"isin": "MXB", "tipoValor": "BONO"}, {"isin": " MX1 ", "tipoValor": "Acciones"}]})),
            ("2/0", "issues", json.dumps({"content": []})), ("2/1", "issues", json.dumps({"content": [{"isin": "MX2", "tipoValor": "ACCIONES"}]}))]
    spark.createDataFrame([(i, k, None, 200, None, None, b) for i, k, b in rows], BRONZE).write.parquet(f"{run}/payloads")
    os.makedirs(to_local(f"{run}/old"))
    with open(to_local(f"{run}/old/map.json"), "w") as fh:
        json.dump({"OLD": "MX9"}, fh)
    args = ["isin", "--payloads", f"{run}/payloads", "--cache", f"{run}/cache", "--json-cache", f"{run}/old/map.json"]
    assert cli.main(args, spark) == 0 and json.loads(capsys.readouterr().out)["entries"] == 1  # the old cache is used
    assert cli.main([*args, "--refresh"], spark) == 0
    assert {r.ticker_key: r.isin for r in read_cache(spark, f"{run}/cache").collect()} == {"ABC": "MX1", "DEF": "MX2"}
    capsys.readouterr()
    assert cli.main(args, spark) == 0 and json.loads(capsys.readouterr().out)["entries"] == 2
