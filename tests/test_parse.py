"""Payload parsers (G1-G6) on hand-written payloads of each shape."""

from pyspark.sql import functions as F

from filingflow.operators import parse as P

GRID = """<div><table class="dxgvTable">
<tr class="dxgvHeader"><td>Fecha</td><td>Emisora</td><td>Asunto</td></tr>
<tr class="dxgvDataRow_Moderno" id="g_DXDataRow0"><td class="c">02/02/2026</td><td class="c"> LAB </td>
<td class="c"><a href="#" onclick="ASPx.PerformCallback(90011);return false;">Aviso de derechos</a></td></tr>
<tr class="dxgvDataRow_Moderno dxgvDataRowAlt_Moderno"><td>03/02/2026</td><td><b>GFNORTE</b></td>
<td><a onclick='cb.PerformCallback(90012)'>Reporte <i>anual</i></a></td></tr>
<tr class="dxgvDataRow_Moderno"><td>only</td><td>two cells</td></tr>
<tr class="dxgvDataRow_Moderno"><td>04/02/2026</td><td>BIMBO</td><td>Dividendo &amp; otros</td></tr>
</table><div class="pager">Página 1 de 4 (66 Envíos)</div></div>"""


def rows_of(df):
    return [(r.pos, r.fecha, r.emisora, r.asunto, r.key) for r in df.orderBy("pos").collect()]


def test_grid_rows(spark):
    df = spark.createDataFrame([(1, GRID)], "id int, body string")
    got = rows_of(P.grid_rows(df, "body", ["id"]))
    assert got == [(0, "02/02/2026", "LAB", "Aviso de derechos", "90011"),
                   (1, "03/02/2026", "GFNORTE", "Reporteanual", "90012"),
                   (3, "04/02/2026", "BIMBO", "Dividendo & otros", None)]


def _delta(seg_len: str, html: str) -> str:
    return (f"{seg_len}|updatePanel|DefaultPlaceholder_UpdatePanelResultados|{html}|"
            "7|hiddenField|__VIEWSTATE|a|b|c|d|3|hiddenField|__EVENTVALIDATION|xyz|")


def test_delta_rows_lengths(spark):
    good = _delta(str(len(GRID)), GRID)
    over = _delta(str(len(GRID) + 5000), GRID)
    bad = _delta("12x", GRID)
    absent = GRID
    short = _delta("10", GRID)
    df = spark.createDataFrame([(i, t) for i, t in enumerate([good, over, bad, absent, short])], "id int, body string")
    counts = {r.id: r.n for r in P.delta_rows(df, "body", ["id"]).groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 3, 1: 3, 2: 3, 3: 3}  # a 10-char segment holds no row


def test_delta_hidden_fields(spark):
    text = _delta(str(len(GRID)), GRID) + "1|hiddenField|__VIEWSTATE|Z|"
    df = spark.createDataFrame([(text,)], "t string")
    old = F.create_map(F.lit("__VIEWSTATE"), F.lit("old"), F.lit("keep"), F.lit("k"))
    m = df.select(P.delta_hidden_fields("t", old).alias("m"), old.alias("o")).first()
    assert m.m == {"__VIEWSTATE": "Z", "__EVENTVALIDATION": "xyz", "keep": "k"}
    assert m.o == {"__VIEWSTATE": "old", "keep": "k"}
    piped = spark.createDataFrame([("7|hiddenField|V|a|b|c|d|",)], "t string")
    assert piped.select(P.delta_hidden_fields("t")).first()[0] == {"V": "a|b|c|d"}


def test_callback_rows(spark):
    inner = GRID.replace("/", "\\/").replace('"', '\\"').replace("'", "\\'").replace("\n", "\\r\\n")
    ok = "/*DX*/({'id':3,'result':'" + inner + "','x':null})"
    no_marker = "({'result':'" + inner + "'})"
    no_result = "/*DX*/({'error':'expired'})"
    df = spark.createDataFrame([(0, ok), (1, no_marker), (2, no_result)], "id int, body string")
    got = P.callback_rows(df, "body", ["id"])
    assert sorted(r.id for r in got.collect()) == [0, 0, 0]
    assert rows_of(got)[0] == (0, "02/02/2026", "LAB", "Aviso de derechos", "90011")


def test_hidden_fields(spark):
    page = ("<form><input type=\"hidden\" name=\"__VIEWSTATE\" value=\"v1\"/>"
            "<input value='e1' type='hidden' name='__EVENTVALIDATION'>"
            "<input type=hidden id=\"onlyid\" value=\"i\">"
            "<input type=\"hidden\" name=\"empty\">"
            "<input type=\"hidden\" name=\"__VIEWSTATE\" value=\"v2\">"
            "<input type=\"submit\" name=\"go\" value=\"Buscar\">"
            "<input type=\"hidden\" value=\"orphan\"></form>")
    df = spark.createDataFrame([(page,)], "h string")
    assert df.select(P.hidden_fields("h")).first()[0] == {
        "__VIEWSTATE": "v2", "__EVENTVALIDATION": "e1", "onlyid": "i", "empty": ""}


def test_json_page_items(spark):
    rows = [('{"content": [{"id": "1", "clave": "A"}, {"id": "2", "clave": "B"}]}',),
            ('{"content": {"id": "1"}}',), ('[{"id": "1"}]',), ('{"other": 1}',), ('{"content": [',), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = [len(r[0]) for r in df.select(P.json_page_items("t", "struct<id:string,clave:string>")).collect()]
    assert got == [2, 0, 0, 0, 0, 0]


HARD = """<table id='t'><!-- <b> -->
<tr data-x="dxgvDataRow"><td>no</td><td>data</td><td>row</td></tr>
<tr title="a > b" onclick="if (1 > 0) f('<td>')" class='x dxgvDataRow_A'><td title='1 > 0'>01/01/2026</td><td>A &gt; B</td>
<td><table><tr><td><a title="c > d" onclick="cb.PerformCallback(7)">Nested <b title=">">subject</b></a></td></tr></table></td></tr>
<tr class=dxgvDataRow><td><table class="in"><tbody><tr><td>02/01</td><td>/2026</td></tr></tbody></table></td><td>C</td><td>plain</td></tr>
<tr class="dxgvDataRow"><td>03/01/2026<td>D</td><td>E</td></tr>
<tr class="dxgvDataRow"><td>04/01/2026</td><td>F</td><td><a href="x" data-onclick="PerformCallback(1)">no link</a></td></tr>
<tr class="dxgvDataRow"><td>05/01/2026</td><td>G</td><td>outer<table><tr class="dxgvDataRow"><td>06/01/2026</td><td>H</td><td>inner</td></tr></table></td></tr>
<tr class="dxgvDataRow"><td>07/01/2026</td><td>I</td><td>unclosed
"""


def test_hard_markup(spark):
    """'>' in attributes, nested tables (whose cells count, in the order in
    which they begin), a data row inside another, a row cut short."""
    for text in (HARD, HARD.replace('"', '\\"')):
        got = rows_of(P.grid_rows(spark.createDataFrame([(1, text)], "id int, body string"), "body", ["id"]))
        assert got[:2] == [(0, "01/01/2026", "A > B", "Nestedsubject", "7"), (1, "02/01/2026", "02/01", "/2026", None)]
        assert got[2] == (2, "03/01/2026DE", "D", "E", None) and got[6:] == [(6, "07/01/2026", "I", "unclosed", None)]
        assert got[3:6] == [(3, "04/01/2026", "F", "no link", None), (4, "05/01/2026", "G", "outer06/01/2026Hinner", None),
                            (5, "06/01/2026", "H", "inner", None)]
    page = """<form><input title="a > b" type="hidden" name="n>1" value="v > w"><input value='type="hidden"' name=t>
<input type=hidden id=i value=bare/><INPUT NAME='x' TYPE=" hidden " disabled></form>"""
    m = spark.createDataFrame([(page,)], "t string").select(P.hidden_fields("t")).first()[0]
    assert m == {"n>1": "v > w", "i": "bare/", "x": ""}


def test_long_attributes_do_not_recurse(spark):
    long = '<tr class="dxgvDataRow" title="' + "x > y = " * 20000 + '"><td>1</td><td>2</td><td ' + "a=b " * 3000 + ">3</td></tr>"
    got = rows_of(P.grid_rows(spark.createDataFrame([(1, long)], "id int, body string"), "body"))
    assert got == [(0, "1", "2", "3", None)]
