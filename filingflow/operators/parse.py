"""Payload parsers (G1-G6) as DataFrame jobs.

Each parser takes a DataFrame with a text column holding one payload per
row and returns rows; the work is regex/explode expressions evaluated inside
whole-stage code generation, so it scales with the number of payloads and
parallelises per partition. No HTML library is involved: the grid markup is
regular (rows, cells, one link per subject cell). Tags are read with their
attributes, so quoted values may hold ``>``; a row with a nested table is
read by a fold over its tags that keeps count of open rows and cells. Entities
are decoded by ``functions.text.html_unescape`` (the whole HTML table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .._col import as_col
from ..functions.text import (DX_MARKER, GRID_ROW_MARKER, ROW_CALLBACK, TAG_RE, TAG_REST, html_unescape, html_unescape_all,
                              other_attributes, strip_tags, strip_ws)

# Markers of the asynchronous page-update format.
DELTA_RESULTS_MARKER = "updatePanel|DefaultPlaceholder_UpdatePanelResultados|"

_BIG = 2_147_483_647

def _holding(marker: str) -> str:
    """Pattern: an attribute value with ``marker`` in it."""
    return (r"""(?:\\?"[^"]*?""" + marker + r"""[^"]*+"|\\?'[^']*?""" + marker + r"""[^']*+'|[^\s>"']*?""" + marker + r"[^\s>]*+)")


ROW_START = r"(?=<[tT][rR][\s>/])"
DATA_ROW_RE = r"(?is)^<tr" + other_attributes("class") + r"class\s*+=\s*+" + _holding(GRID_ROW_MARKER)
ROW_BODY_RE = r"(?is)^<tr" + TAG_REST + r"(.*?)(?:</tr\s*>|\z)"
CELL_RE = r"(?is)<td(?=[\s>/])" + TAG_REST + r"(.*?)</td\s*>"
LINK_RE = (r"(?is)<a(?=[\s/])" + other_attributes("onclick") + r"onclick\s*+=\s*+(" + _holding(ROW_CALLBACK) + ")" + TAG_REST
           + r"(.*?)</a\s*>")
KEY_RE = ROW_CALLBACK + r"\((\d+)\)"
#: a row's or cell's tag, and what lies between two of them in pieces of up to
#: 64 tags and texts (the recursion depth of the repetition)
CELL_TAG_RE = r"(?i)^<(/?t[rd])[\s>/]"
CELL_MARKUP_RE = r"(?:(?!</?[tT][rRdD][\s>/])(?:" + TAG_RE + r"|[^<]++|<)){1,64}+|" + TAG_RE + "|<"
_CELLS = "struct<depth:int,done:boolean,open:array<int>,n:int,c0:string,c1:string,c2:string>"


def nested_cells(markup: Column) -> Column:
    """The inner markup of the first three cells of a row, for text that
    begins after the row's start tag and may run on beyond its end. Cells are
    numbered as they begin, those of nested tables too; a cell holds all
    markup between its own tags. An array, empty for fewer than three cells."""
    start = F.struct(F.lit(1).alias("depth"), F.lit(False).alias("done"), F.array().cast("array<int>").alias("open"), F.lit(0).alias("n"),
                     F.lit("").alias("c0"), F.lit("").alias("c1"), F.lit("").alias("c2")).cast(_CELLS)

    def step(acc, s):
        t, kind = s["t"], s["kind"]
        begins = kind == "td"
        depth = acc["depth"] + F.when(kind == "tr", 1).when(kind == "/tr", -1).otherwise(0)
        inside = F.when(kind == "/td", F.slice(acc["open"], 1, F.greatest(F.size(acc["open"]) - 1, F.lit(0)))).otherwise(acc["open"])
        done = depth <= 0

        def cell(i):
            name = f"c{i}"
            return F.when(~done & F.array_contains(inside, F.lit(i)), F.concat(acc[name], t)).otherwise(acc[name]).alias(name)

        moved = F.struct(depth.alias("depth"), done.alias("done"), F.when(begins, F.concat(inside, F.array(acc["n"]))).otherwise(inside).alias("open"),
                         F.when(begins & ~done, acc["n"] + 1).otherwise(acc["n"]).alias("n"), *[cell(i) for i in range(3)]).cast(_CELLS)
        return F.when(acc["done"], acc).otherwise(moved)

    # what a piece is gets looked up once: the fold asks for it many times
    tokens = F.transform(F.regexp_extract_all(markup, F.lit(CELL_MARKUP_RE), 0),
                         lambda t: F.struct(t.alias("t"), F.lower(F.regexp_extract(t, CELL_TAG_RE, 1)).alias("kind")))
    return F.aggregate(tokens, start, step, lambda acc: F.when(acc["n"] >= 3, F.array(acc["c0"], acc["c1"], acc["c2"])).otherwise(F.array().cast("array<string>")))


def _own_parts(parts: Column, first: Column) -> Column:
    """Markup of a row that begins with part number ``first`` (a page is cut
    where rows begin): its part, and those that follow up to the one in which
    the tables inside it are closed."""
    start = F.struct(F.lit(0).alias("tables"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("of")).cast(
        "struct<tables:int,done:boolean,of:array<string>>")

    def step(acc, p):
        tables = acc["tables"] + F.regexp_count(p, F.lit(r"(?i)<table[\s>/]")) - F.regexp_count(p, F.lit(r"(?i)</table[\s>]"))
        return F.when(acc["done"], acc).otherwise(F.struct(tables.alias("tables"), (tables <= 0).alias("done"), F.concat(acc["of"], F.array(p)).alias("of")))

    return F.aggregate(F.slice(parts, first + 1, F.size(parts)), start, step, lambda acc: F.array_join(acc["of"], ""))


def grid_rows(df: DataFrame, html_col: str = "body", keep: list[str] | None = None) -> DataFrame:
    """G1: grid HTML -> one row per data row (``pos`` = 0-based row index).

    Output: kept columns + pos, fecha, emisora, asunto, key (string, null when
    the subject cell has no callback link). Rows with fewer than three cells
    are dropped (P10). The page is cut where rows begin; a row with cells inside
    cells is read to its own end, over the rows inside it."""
    keep = keep or []
    parts = df.select(*keep, F.split(F.col(html_col), ROW_START).alias("_parts"))
    data = F.filter(F.transform("_parts", lambda p, i: F.struct(i.alias("i"), p.alias("p"))), lambda s: s["p"].rlike(DATA_ROW_RE))
    # lambdas have no common subexpressions: what is used again is a field
    own = F.transform(data, lambda s: F.struct(s["i"].alias("i"), F.regexp_extract(s["p"], ROW_BODY_RE, 1).alias("own")))

    def nested(s):
        # cells in cells: a table inside, or a cell that isn't closed
        return F.struct(s["i"].alias("i"), s["own"].alias("own"), (s["own"].rlike(r"(?i)<table[\s>/]") | (
            F.regexp_count(s["own"], F.lit(r"(?i)<td[\s>/]")) != F.regexp_count(s["own"], F.lit(r"(?i)</td[\s>]")))).alias("nested"))

    def cells(s):
        whole = F.regexp_replace(_own_parts(F.col("_parts"), s["i"]), r"(?is)\A<tr" + TAG_REST, "")
        return F.when(s["nested"], nested_cells(whole)).otherwise(F.regexp_extract_all(s["own"], F.lit(CELL_RE), 1))

    # cells are computed below the explode, so the filter can't repeat them
    rows = parts.select(*keep, F.posexplode(F.transform(F.transform(own, nested), cells)).alias("pos", "_td")).filter(F.size("_td") >= 3)
    # the subject cell's callback link: what its attribute holds, and its text
    rows = rows.select(*keep, "pos", "_td", F.regexp_extract(F.get(F.col("_td"), 2), LINK_RE, 1).alias("_on"),
                       F.regexp_extract(F.get(F.col("_td"), 2), LINK_RE, 2).alias("_a"))
    has_link = F.col("_on") != ""
    key = F.nullif(F.regexp_extract("_on", KEY_RE, 1), F.lit(""))
    # tags are stripped into columns first: each cell regex runs once
    cells = rows.select(
        *keep, "pos",
        strip_tags(F.get(F.col("_td"), 0)).alias("_f"),
        strip_tags(F.get(F.col("_td"), 1)).alias("_e"),
        strip_tags(F.when(has_link, F.col("_a")).otherwise(F.get(F.col("_td"), 2))).alias("_s"),
        F.when(has_link, key).alias("key"))
    texts = cells.select(*keep, "pos", html_unescape_all([F.col("_f"), F.col("_e"), F.col("_s")], strip_ws).alias("_texts"), "key")
    return texts.select(*keep, "pos", *[F.get("_texts", i).alias(n) for i, n in enumerate(("fecha", "emisora", "asunto"))], "key")


def delta_grid_html(text) -> Column:
    """G2 (text part): the results segment of a delta response, cut by its
    length prefix; with a bad length it is the rest of the text (what follows
    the segment holds no grid rows); without the marker the whole text is
    returned."""
    t = as_col(text)
    idx = F.instr(t, DELTA_RESULTS_MARKER)
    start = idx + F.lit(len(DELTA_RESULTS_MARKER))
    before = F.substring(t, F.lit(1), idx - 1)
    has_pipe = F.instr(before, "|") > 0
    len_text = F.regexp_extract(before, r"(?s)([^|]*)\|[^|]*$", 1)
    seg_len = F.trim(len_text).try_cast("int")
    seg = F.when(has_pipe & seg_len.isNotNull(), F.substring(t, start, F.greatest(seg_len, F.lit(0)))) \
           .otherwise(F.substring(t, start, F.lit(_BIG)))
    return F.when(idx > 0, seg).otherwise(t)


def delta_rows(df: DataFrame, text_col: str = "body", keep: list[str] | None = None) -> DataFrame:
    """Delta response -> grid rows."""
    keep = keep or []
    return grid_rows(df.select(*keep, delta_grid_html(F.col(text_col)).alias("_html")), "_html", keep)


# The callback's result string, and the escape sequences in it.
# Unrolled loop with possessive runs: recursion depth follows the number of
# escapes, not the payload length (Java regex recurses per repetition).
RESULT_RE = r"(?s)'result'\s*:\s*'([^'\\]*+(?:\\.[^'\\]*+)*+)'"
ESCAPES = (("\\'", "'"), ("\\r\\n", "\n"), ("\\n", "\n"), ("\\/", "/"))


def callback_grid_html(text) -> Column:
    """G3 (text part): the single-quoted ``result`` string behind the marker
    of a callback, its escape sequences undone; '' without marker or result
    (null for a null text). The pattern runs once."""
    t = as_col(text)
    pos = F.instr(t, DX_MARKER)
    inner = F.regexp_extract(F.when(pos > 0, F.substring(t, pos + len(DX_MARKER), F.lit(_BIG))).otherwise(F.lit("")), RESULT_RE, 1)
    for escaped, plain in ESCAPES:
        inner = F.replace(inner, F.lit(escaped), F.lit(plain))
    return inner


def callback_rows(df: DataFrame, text_col: str = "body", keep: list[str] | None = None) -> DataFrame:
    """Grid callback -> grid rows (zero rows when the payload is not one).
    The filter is a plain search for the marker; an empty result holds no rows."""
    keep = keep or []
    inner = df.filter(F.instr(F.col(text_col), DX_MARKER) > 0).select(*keep, callback_grid_html(F.col(text_col)).alias("_html"))
    return grid_rows(inner, "_html", keep)


def _attr_raw(tag: Column, name: str) -> Column:
    """Raw attribute text with its quotes ('' when absent, '""' when empty)."""
    pat = r"(?is)^<\w++" + other_attributes(name) + name + r"""\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
    return F.regexp_extract(tag, pat, 1)


def _unquote(raw: Column) -> Column:
    quoted = raw.startswith('"') | raw.startswith("'")
    return F.when(quoted, F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)


_HIDDEN_TYPE = r"(?is)^<input" + other_attributes("type") + r"""type\s*+=\s*+(?:"\s*hidden\s*"|'\s*hidden\s*'|hidden(?=[\s/>]|$))"""


def hidden_fields(html) -> Column:
    """Map name (or id) -> value of the hidden inputs of a page; later
    duplicates win (session policy LAST_WIN); missing value -> ''. Inputs are
    first narrowed to hidden ones; each attribute regex then runs once per
    input (a first pass builds a struct of raw attributes, the second pass
    works on its fields: lambdas get no common-subexpression elimination)."""
    tags = F.regexp_extract_all(as_col(html), F.lit(r"(?is)<input(?=[\s/>])" + TAG_REST), 0)
    hidden = F.filter(tags, lambda t: t.rlike(_HIDDEN_TYPE))
    raw = F.transform(hidden, lambda t: F.array(*[_attr_raw(t, n) for n in ("name", "id", "value")]))
    raw = F.transform(raw, lambda r: F.transform(r, _unquote))
    raw = F.transform(raw, lambda r: F.transform(r, html_unescape))

    def entry(r):
        name, ident = F.get(r, 0), F.get(r, 1)
        key = F.when(name != "", name).when(ident != "", ident)
        return F.when(key.isNotNull(), F.struct(key.alias("k"), F.get(r, 2).alias("v")))

    entries = F.filter(F.transform(raw, entry), lambda e: e.isNotNull())
    return F.map_from_entries(entries)


# Fixed value: header of a hidden field in a delta response.
_DELTA_FIELD_RE = r"(\d+)\|hiddenField\|([^|]+)\|"


def delta_hidden_fields(text, existing=None) -> Column:
    """Length-prefixed hidden fields of a delta response merged over an
    existing map (right-biased). Values may contain '|': the length prefix
    is honoured. Header positions are found by a left fold that searches
    each header from the end of the previous one."""
    t = as_col(text)
    headers = F.regexp_extract_all(t, F.lit(_DELTA_FIELD_RE), 0)
    init = F.struct(F.lit(1).alias("pos"),
                    F.array().cast("array<struct<k:string,v:string>>").alias("kv"))

    def step(acc, h):
        p = F.call_function("locate", h, t, acc["pos"])
        vstart = p + F.length(h)
        n = F.regexp_extract(h, _DELTA_FIELD_RE, 1).try_cast("int")
        name = F.regexp_extract(h, _DELTA_FIELD_RE, 2)
        val = F.when(n.isNull(), F.lit("")).otherwise(F.substring(t, vstart, n))
        return F.struct(vstart.alias("pos"),
                        F.concat(acc["kv"], F.array(F.struct(name.alias("k"), val.alias("v")))).alias("kv"))

    folded = F.aggregate(headers, init, step)
    new_map = F.map_from_entries(folded["kv"])
    if existing is None:
        return new_map
    return F.map_concat(F.coalesce(as_col(existing), F.create_map().cast("map<string,string>")), new_map)


def json_page_items(text, item_schema: str) -> Column:
    """Items of a JSON page: the ``content`` array when it is a list,
    else an empty array; a payload that is not an object gives no items."""
    parsed = F.from_json(as_col(text), f"struct<content: array<{item_schema}>>",
                         {"mode": "PERMISSIVE"})
    is_obj = F.coalesce(F.trim(as_col(text)).startswith("{"), F.lit(False))
    content_is_list = F.coalesce(F.get_json_object(as_col(text), "$.content").startswith("["),
                                 F.lit(False))
    return F.when(is_obj & content_is_list & parsed["content"].isNotNull(), parsed["content"]) \
            .otherwise(F.array().cast(f"array<{item_schema}>"))
