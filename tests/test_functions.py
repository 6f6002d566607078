"""Scalar functions (F1-F26) on hand-made rows."""

import datetime as dt
import hashlib
import html

import pytest
from pyspark.sql import functions as F

from conftest import one_col
from filingflow.functions import dates as D
from filingflow.functions import docs as X
from filingflow.functions import text as T
from filingflow.operators import aggregates as A


def apply(spark, values, fn, typ="string"):
    df = one_col(spark, values, "x", typ)
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


@pytest.mark.parametrize("raw,expected", [
    ("07/11/2025", "2025-11-07"),
    ("2025-11-07", "2025-11-07"),
    ("2025-11-07T08:15:00", "2025-11-07"),
    ("07/11/2025 08:15:00", "2025-11-07"),
    ("", ""),
    (None, None),
    ("someday", "someday"),
    ("07/11", "07/11"),
    ("88/77/2031", "2031-77-88"),
    ("07/11/20/5", "07/11/20/5"),
    ("2025/11/07", "2025/11/07"),
    ("31/01/1999", "1999-01-31"),
])
def test_normalize_date(spark, raw, expected):
    assert apply(spark, [raw], D.normalize_date) == [expected]


@pytest.mark.parametrize("headline,expected", [
    ("Reporte anual de sustentabilidad", "annual_report"),
    ("INFORME ANUAL", "annual_report"),
    ("annual   report", "annual_report"),
    ("Estado financieros trimestrales", "financial_results"),
    ("prospectos preliminares", "prospectus"),
    ("Oferta Publica de adquisicion", "public_offering"),
    ("oferta PÚBLICA", "public_offering"),
    ("asamblea extraordinaria", "shareholder_meeting"),
    ("JUNTA DE ACCIONISTAS", "shareholder_meeting"),
    ("Dividendos decretados", "dividend"),
    ("FUSIÓN Y ESCISIÓN", "corporate_action"),
    ("Adquisiciones recientes", "corporate_action"),
    ("CALIFICACIÓN DE DEUDA", "credit_rating"),
    ("Rating upgrade", "credit_rating"),
    ("Operating income", "credit_rating"),
    ("Ventas del mes", "other"),
    ("informe\u00a0anual", "annual_report"),
    ("comunicado\u2003de prensa", "press_release"),
    ("Operating rating", "credit_rating"),
    ("Designación del auditor", "auditor_change"),
    ("Segundo trimestre", "quarterly_report"),
    ("Informe semestral", "semi_annual_report"),
    ("Hecho relevante", "material_event"),
    ("Material events", "material_event"),
    ("Press release", "press_release"),
    ("Comunicado de prensa", "press_release"),
    ("actualización", "update"),
    ("Updated terms", "update"),
    ("Resultados trimestrales", "other"),
    ("Hecho relevante sobre dividendo", "dividend"),
    ("", "other"),
    (None, "other"),
])
def test_classify(spark, headline, expected):
    assert apply(spark, [headline], T.classify_filing_type) == [expected]


@pytest.mark.parametrize("name,expected", [
    ("plain.pdf", "plain.pdf"),
    ("a/b\\c.pdf", "a_b_c.pdf"),
    ('q"u<o>t:e|s?*.pdf', "q_u_o_t_e_s__.pdf"),
    ("..hidden..", "hidden"),
    ("  spaced  ", "spaced"),
    ("ctl\x01\x1fchars", "ctl__chars"),
    (". . .", ""),
])
def test_sanitize(spark, name, expected):
    assert apply(spark, [name], T.sanitize_filename) == [expected]


def test_ticker_key_and_filing_id(spark):
    assert apply(spark, ["  abc ", "", None, "Xy z"], T.ticker_key) == ["ABC", None, None, "XY Z"]
    df = spark.createDataFrame([("12", "h"), (None, "á" * 50), ("", "short")], "k string, h string")
    ids = T.filing_id("k", "h", F.lit("01/02/2026"), F.lit(None).cast("string"))
    digest = [hashlib.sha256("\x1f".join([h, "01/02/2026", ""]).encode()).hexdigest() for h in ("á" * 50, "short")]
    assert [r[0] for r in df.select(ids).collect()] == ["cnbv_12", "cnbv_" + digest[0], "cnbv_" + digest[1]]


@pytest.mark.parametrize("raw,expected", [
    ("a &amp; b", "a & b"), ("&amp;lt;", "&lt;"), ("&#233;t&#xE9;", "été"), ("&#39;x&#x27;", "'x'"),
    ("caf&eacute; &copy; &middot;", "café © ·"), ("&nbsp;", "\u00a0"), ("&#0; &#xFFFFFFF; &bogus;", "\ufffd \ufffd &bogus;"),
    ("&ldquo;a&rdquo; &ouml; &sect; &aacute &notit; &amp &#150; &#39x", html.unescape("&ldquo;a&rdquo; &ouml; &sect; &aacute &notit; &amp &#150; &#39x")),
    ("&amp;#39;", "&#39;"), ("no entities", "no entities"),
])
def test_html_unescape(spark, raw, expected):
    assert apply(spark, [raw], T.html_unescape) == [expected]


def test_epoch_ms(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 3, 15, 10, 30, 0, 123456),)], "t timestamp_ntz")
    got = df.select(D.epoch_ms_text("t")).first()[0]
    assert got == str(int((dt.datetime(2026, 3, 15, 10, 30, 0, 123456) - dt.datetime(1970, 1, 1)).total_seconds() * 1000))


@pytest.mark.parametrize("text,js,err", [
    ('{"a": 1}', '{"a": 1}', False),
    ('```json\n{"a": 2}\n```', '{"a": 2}', False),
    ('```\n{"a": 3}```', '{"a": 3}', False),
    ('json {"a": 4}', '{"a": 4}', False),
    ('The answer is {"a": 5}', None, True),
    ('"k": 1}', None, True),
    ('{"a": 1}}', None, True),
    ('{"a": 1} {"b": 2}', None, True),
    ('[1] [2]', None, True),
    ('{"s": "}{ [x] }}"}', '{"s": "}{ [x] }}"}', False),
    ('{"a": [1, {"b": 2}], "c": {}}', '{"a": [1, {"b": 2}], "c": {}}', False),
])
def test_fenced_json(spark, text, js, err):
    df = one_col(spark, [text], "t")
    out = X.with_model_json(df, "t", "js", "err").first()
    assert (out["js"], out["err"]) == (js, err)


@pytest.mark.parametrize("raw,expected", [
    ("a%20b", "a b"), ("a+b", "a+b"), ("R%C3%A9sum%C3%A9", "Résumé"), ("100%", "100%"),
    ("a%zzb%20c", "a%zzb c"), ("%2", "%2"), ("%E2%82", "\ufffd"), ("plain", "plain"), ("", ""),
])
def test_percent_decode(spark, raw, expected):
    assert apply(spark, [raw], X.percent_decode) == [expected]


def test_download_names(spark):
    rows = [
        ("attachment; filename=\"R%C3%A9sum%C3%A9+v2.pdf\"", "x", True),
        ("", "Informe: Q3", True),
        ("", "tabla.XLSX", False),
        ("", "bin", False),
        ("inline; filename=a%zzb.pdf; size=3", "x", True),
    ]
    df = spark.createDataFrame(rows, "cd string, att string, pdf boolean")
    got = [r[0] for r in df.select(X.resolve_file_name("cd", "att", "pdf")).collect()]
    assert got == ["Résumé+v2.pdf", "Informe_ Q3.pdf", "tabla.XLSX", "bin.bin", "a%zzb.pdf"]


def test_download_acceptance(spark):
    rows = [("application/pdf", "xxxx"), ("text/html", "%PDF"), ("application/octet-stream", "PK.."),
            ("text/html; charset=utf-8", "<htm"), ("application/xhtml+html", "<htm"), (None, None)]
    df = spark.createDataFrame(rows, "ct string, head string")
    got = [(r[0], r[1]) for r in df.select(X.is_pdf_response("ct", "head"), X.is_file_response("ct")).collect()]
    assert got == [(True, True), (True, False), (False, True), (False, False), (False, False), (False, False)]


def test_attached_name_and_hint(spark):
    df = spark.createDataFrame([("Archivo adjunto:  reporte.pdf \nmore", "h.pdf"), ("nothing", "h.pdf"),
                                ("nothing", "")], "t string, h string")
    got = [r[0] for r in df.select(X.attached_name("t", "h")).collect()]
    assert got == ["reporte.pdf", "h.pdf", "document.pdf"]
    df2 = spark.createDataFrame([("ACME", "Aviso"), (None, "x")], "e string, a string")
    assert [r[0] for r in df2.select(X.name_hint("e", "a")).collect()] == ["ACME_Aviso.pdf", "_x.pdf"]


def test_token_and_pager(spark):
    vals = ["/*DX*/<a href=\\\"Detalle.aspx?enc=AbC%2Bd%3D&amp;x=1\\\">",
            "/*DX*/<div>no link<\\/div>", "enc=NOMARKER", None]
    assert apply(spark, vals, T.token_from_callback) == ["AbC%2Bd%3D", None, None, None]
    df = one_col(spark, ["Página 2 de 9 (171 Envíos)", "nothing"], "t")
    got = [tuple(r) for r in df.select(*T.pager_totals("t")).collect()]
    assert got == [(9, 171), (1, 0)]


def test_detail_fields_and_error_page(spark):
    html = ("<html><head><title>Detalle</title></head><body>\n<p>Emisora: ACME SAB</p>\n"
            "<p>Asunto : Aviso de derechos</p>\n<p>Fecha de recepción (hora local): 03/02/2026 10:00</p>\n"
            "</body></html>")
    df = spark.createDataFrame([(html, 200), ("<title>Error de sistema</title>", 200), ("<p>x</p>", 404)],
                               "h string, st int")
    f = T.detail_fields(F.col("h"))
    rows = df.select(f["emisora"], f["asunto"], f["fecha"], T.is_error_page("h", "st")).collect()
    assert tuple(rows[0]) == ("ACME SAB", "Aviso de derechos", "03/02/2026 10:00", False)
    assert rows[1][0] == "?" and rows[1][3] is True
    assert rows[2][3] is True


def test_suffix_kind(spark):
    vals = ["a/b.PDF", "x.xls", "y.XLSX", "z.zip", "w.docx", "noext"]
    assert apply(spark, vals, X.suffix_kind) == ["pdf", "spreadsheet", "spreadsheet", "zip", "unsupported",
                                                 "unsupported"]


def test_health_rules(spark):
    as_of = dt.datetime(2026, 5, 10, 12, 0, 0)
    rows = [(None, None, None), (1, None, None), (2, "2026-05-01T00:00:00", None),
            (3, "2026-05-10T00:00:00", "boom"), (4, "2026-05-10T00:00:00", "   "),
            (5, "garbage", None)]
    df = spark.createDataFrame(rows, "id long, completed_at string, errors string")
    h = A.health_of(F.col("id"), F.col("completed_at"), F.col("errors"), as_of)
    got = [(r[0], r[1]) for r in df.select(h.alias("h"), A.exit_code(h)).collect()]
    assert got == [("empty", 2), ("error", 3), ("stale", 1), ("degraded", 0), ("ok", 0), ("stale", 1)]


def test_duration_and_age(spark):
    df = spark.createDataFrame([("2026-01-01T00:00:00", dt.datetime(2026, 1, 1, 0, 1, 30)), ("bad", None)],
                               "s string, e timestamp")
    got = [r[0] for r in df.select(D.duration_seconds("s", "e")).collect()]
    assert got == [90.0, None]
    ages = [r[0] for r in one_col(spark, ["2026-01-01T00:00:00", "nope"], "c").select(
        D.age_hours("c", F.lit("2026-01-02 12:00:00").cast("timestamp"))).collect()]
    assert ages == [36.0, float("inf")]


@pytest.mark.parametrize("text", [
    "{}", "[]", '{"a": 1}', "[1, 2, [3, {}]]", '"x"', "-1.5e+3", "0", "true", "null", ' {"a": {"b": [1, {"c": "}]"}]}} ', '{"a": "\\u00e9\\n\\""}',
    "NaN", '[-Infinity]', '{"a": 1, "a": 2}',
    "", " ", "{", "}", "[1 2]", '{"a" 1}', '{"a": 1,}', "[1,]", "[,1]", '{"a": 1},{"b": 2}', "{} {}", "[1]]", "01", "-", "1.", ".5", "+1", "1e", "tru",
    "truefalse", "1 2", '"a', '"a\nb"', '"\\x"', '"\\u12"', "{1: 2}", "{'a': 1}", '{"a": }', '{"a"}', '["a": 1]', "[}", "{]", '{"a": 1]', "nan", "[1, 2", "//",
    '{"a": undefined}', "[" * 300 + "]" * 300, "[" * 300 + "]" * 299])
def test_strict_json(spark, text):
    import json
    try:
        json.loads(text)
        want = True
    except ValueError:
        want = False
    assert one_col(spark, [text]).select(X.is_json("x")).first()[0] is want
