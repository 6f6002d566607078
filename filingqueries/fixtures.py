"""Inputs derived from the driver's test tables.

The test data holds no filings, so filing-shaped rows are *derived* from
``orders``/``customer`` with one expression in Spark and the same expression
in SQL (``*_SQL`` below) so that the oracle needs no parser. Payload
renderers turn those rows into the portal's page formats; the parsers then
have to give the source columns back (render -> parse round trip).

Renderers group rows by page (a bounded 20 rows per group), so no group grows
with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.functions.text import GRID_ROW_MARKER, ROW_CALLBACK
from filingflow.operators.windows import page_of

# Fixed test values: one headline per rule, plus case/accent variants, a
# headline matching two rules, a 'rating' inside a word, and non-matches.
HEADLINES = [
    "Informe anual sustentable, ejercicio cerrado",
    "REPORTE ANUAL DEL CONSEJO",
    "Annual Report to shareholders",
    "Resultados Financieros del 3T",
    "Estados financieros dictaminados",
    "Prospecto “preliminar” de notas § 4",
    "Aviso de Oferta Pública & canje",
    "OFERTA PÚBLICA INICIAL",
    "Asamblea General Ordinaria",
    "Convocatoria a junta de accionistas",
    "Pago de dividendo en efectivo",
    "FUSIÓN con subsidiaria",
    "Escisión de la sociedad",
    "Adquisicion de activos",
    "CALIFICACIÓN crediticia",
    "Nombramiento por cambio de auditor: Garçon & Söhne",
    "Reporte Trimestral <4T>",
    "Primer trimestre",
    "Informe semestral",
    "Evento Relevante",
    "Hecho relevante: dividendo",
    "Material event notice",
    "Comunicado de prensa núm. 12",
    "Press Release",
    "Actualización de datos",
    "Operating results",
    "Resultados trimestrales",
    "Aviso general a los tenedores con un titulo bastante largo",
    "",
]
ROWS_PER_PAGE = 20


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(values: list[str], idx: Column) -> Column:
    """values[idx] (0-based) as a Column."""
    return F.get(F.array(*[F.lit(v) for v in values]), idx.cast("int"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------------------
# Filing rows from orders (+ customer names)
# ---------------------------------------------------------------------------

def order_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One filing per order: key (null for every 7th), date text, issuer
    (customer name in three spellings), headline, page and position."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("o_orderkey")
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
             .select(
                 k.alias("o_orderkey"),
                 F.when(k % 7 != 3, k.cast("string")).alias("key"),
                 F.date_format("o_orderdate", "dd/MM/yyyy").alias("fecha"),
                 F.when(k % 5 == 1, F.lower("c_name"))
                  .when(k % 5 == 2, F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
                  .otherwise(F.col("c_name")).alias("emisora"),
                 F.concat(pick(HEADLINES, k % len(HEADLINES)), F.lit(" "), F.col("o_orderpriority"))
                  .alias("asunto"),
                 page_of(k + 1, ROWS_PER_PAGE).alias("page"),
                 (k % ROWS_PER_PAGE).cast("int").alias("pos"),
             ))


ORDER_FILINGS_SQL = f"""
order_filings AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 <> 3 THEN CAST(o_orderkey AS VARCHAR) END AS key,
         strftime(o_orderdate, '%d/%m/%Y') AS fecha,
         CASE WHEN o_orderkey % 5 = 1 THEN lower(c_name)
              WHEN o_orderkey % 5 = 2 THEN '  ' || c_name || ' '
              ELSE c_name END AS emisora,
         {sql_list(HEADLINES)}[(o_orderkey % {len(HEADLINES)}) + 1] || ' ' || o_orderpriority AS asunto,
         CAST(floor(o_orderkey / {ROWS_PER_PAGE}) + 1 AS BIGINT) AS page,
         CAST(o_orderkey % {ROWS_PER_PAGE} AS INTEGER) AS pos
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
)"""


def html_escape(c: Column) -> Column:
    x = F.replace(c, F.lit("&"), F.lit("&amp;"))
    x = F.replace(x, F.lit("<"), F.lit("&lt;"))
    x = F.replace(x, F.lit(">"), F.lit("&gt;"))
    # named, bare (no semicolon) and numeric references
    for ch, ref in (("“", "&ldquo;"), ("”", "&#8221;"), ("ö", "&ouml;"), ("§", "&sect;"), ("ç", "&#xE7;"), ("ú", "&uacute")):
        x = F.replace(x, F.lit(ch), F.lit(ref))
    return x


def render_row(f: DataFrame) -> Column:
    """One grid ``<tr>``; alternate rows carry a second class; key-less rows
    have a plain subject cell. Cells carry padding and inner tags."""
    cls = F.when(F.col("pos") % 2 == 1,
                 F.lit(f"{GRID_ROW_MARKER}_Aqua {GRID_ROW_MARKER}Alt")).otherwise(F.lit(f"{GRID_ROW_MARKER}_Aqua"))
    subj = html_escape(F.col("asunto"))
    cell3 = F.when(F.col("key").isNotNull(),
                   F.concat(F.lit('<a title="1 > 0" href="javascript:void(0)" onclick="cbp.'), F.lit(ROW_CALLBACK), F.lit("("),
                            F.col("key"), F.lit(');">'), subj, F.lit("</a>"))) \
             .otherwise(F.concat(F.lit(" "), subj, F.lit(" ")))
    # every fifth row has tags with '>' in attribute values, every sixth a table around its subject
    subject = F.when(F.col("pos") % 6 == 2, F.concat(F.lit('<table class="in"><tbody><tr><td class="x">'), cell3, F.lit("</td></tr></tbody></table>"))).otherwise(cell3)
    return F.concat(
        F.lit('<tr id="r'), F.col("pos").cast("string"), F.when(F.col("pos") % 5 == 3, F.lit('" title="a > b')).otherwise(F.lit("")), F.lit('" class="'), cls, F.lit('">'),
        F.lit('<td class="dxgv"> <span>'), F.col("fecha"), F.lit("</span> </td>"),
        F.lit('<td class="dxgv">'), html_escape(F.coalesce(F.col("emisora"), F.lit(""))), F.lit("</td>"),
        F.when(F.col("pos") % 5 == 3, F.lit('<td title="x > y" class="dxgv">')).otherwise(F.lit('<td class="dxgv">')), subject, F.lit("</td></tr>\n"))


def render_grid_pages(filings: DataFrame, total_pages: int = 0, total_rows: int = 0) -> DataFrame:
    """Bronze rows (page, kind='grid', body): one HTML grid per page, rows in
    position order, a pager line at the end. Groups hold at most 20 rows."""
    # a count of its own: the little text that is shuffled says nothing of the
    # work on it, and a few large tasks would leave cores idle at the end
    spark = filings.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    rows = filings.repartition(parts, "page").select("page", "pos", render_row(filings).alias("tr"))
    pages = rows.groupBy("page").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "tr"))), lambda s: s["tr"]), "")
         .alias("trs"))
    return pages.select(
        "page", F.lit("grid").alias("kind"),
        # every seventh page opens with a long comment, as pages with scripts do
        F.concat(F.lit('<table id="grid"><tbody>\n'), F.when(F.col("page") % 7 == 0, F.repeat(F.lit("<!-- filler -->"), 4000)).otherwise(F.lit("")), F.col("trs"),
                 # a data-classed summary row with two cells: dropped by the parser (P10)
                 F.lit(f'<tr class="{GRID_ROW_MARKER}_Aqua"><td colspan="2">Total</td><td>20</td></tr>\n'),
                 F.lit('</tbody></table><div class="pager">P&aacute;gina '), F.col("page").cast("string"),
                 F.lit(f" de {total_pages} ({total_rows} Env&iacute;os)</div>")).alias("body"))


def render_delta_pages(grid: DataFrame) -> DataFrame:
    """Delta responses around grid pages: ``LEN|updatePanel|ID|HTML|`` then
    two hidden fields (one value contains '|'). Every 5th page has a bad
    length, every 5th+1 an overlong one, every 5th+2 no marker at all."""
    body = F.col("body")
    n = F.length(body)
    vs = F.concat(F.lit("vs"), F.col("page").cast("string"), F.lit("|x"))
    ev = F.concat(F.lit("ev"), F.col("page").cast("string"))
    length_txt = (F.when(F.col("page") % 5 == 0, F.lit("n/a"))
                   .when(F.col("page") % 5 == 1, (n + 1000).cast("string"))
                   .otherwise(n.cast("string")))
    fields = F.concat(F.length(vs).cast("string"), F.lit("|hiddenField|__VIEWSTATE|"), vs, F.lit("|"),
                      F.length(ev).cast("string"), F.lit("|hiddenField|__EVENTVALIDATION|"), ev, F.lit("|"))
    panel = F.when(F.col("page") % 5 == 2, F.concat(F.lit("0|asyncPostBackControlIDs||"), body, F.lit("|"))) \
             .otherwise(F.concat(length_txt, F.lit("|updatePanel|DefaultPlaceholder_UpdatePanelResultados|"),
                                 body, F.lit("|")))
    return grid.select("page", F.lit("delta").alias("kind"), F.concat(panel, fields).alias("body"))


def js_escape(c: Column) -> Column:
    """Escape HTML into a single-quoted script string the way the portal's
    callbacks do: backslash-quotes, escaped slashes and newlines."""
    x = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    x = F.replace(x, F.lit("'"), F.lit("\\'"))
    x = F.replace(x, F.lit('"'), F.lit('\\"'))
    x = F.replace(x, F.lit("/"), F.lit("\\/"))
    return F.replace(x, F.lit("\n"), F.lit("\\r\\n"))


def render_callback_pages(grid: DataFrame) -> DataFrame:
    """Grid callbacks: ``/*DX*/({'result':'<escaped html>', ...})``; every
    11th page lacks the marker and every 13th the result (both -> 0 rows)."""
    res = F.concat(F.lit("/*DX*/({'id':1,'result':'"), js_escape(F.col("body")), F.lit("','cp':null})"))
    body = (F.when(F.col("page") % 11 == 4, F.concat(F.lit("({'result':'"), js_escape(F.col("body")), F.lit("'})")))
             .when(F.col("page") % 13 == 6, F.lit("/*DX*/({'error':'session expired'})"))
             .otherwise(res))
    return grid.select("page", F.lit("grid_callback").alias("kind"), body.alias("body"))


def token_of(key: Column) -> Column:
    """The (percent-encoded) token the portal would return for a key."""
    return F.concat(F.lit("Tk"), key.cast("string"), F.lit("%2B"), (key * 7 % 1000).cast("string"), F.lit("%3D"))


TOKEN_SQL = "'Tk' || CAST({k} AS VARCHAR) || '%2B' || CAST(({k} * 7) % 1000 AS VARCHAR) || '%3D'"


def render_token_callback(key: Column) -> Column:
    """Token callback for a key; keys divisible by 11 get an error fragment
    without a link."""
    link = F.concat(F.lit("/*DX*/<div><a href=\\\"Detalle.aspx?enc="), token_of(key),
                    F.lit("&amp;p=1\\\" target=\\'_blank\\'>Ver<\\/a><\\/div>"))
    return F.when(key % 11 == 0, F.lit("/*DX*/<div class=\\\"err\\\">Sin documento<\\/div>")).otherwise(link)
