"""Text functions as native Column expressions (no Python UDFs).

Java regex notes: ``(?U)`` makes ``\\s``/``\\d``/``\\w`` and case folding
Unicode-aware (Python ``re`` on ``str`` is Unicode by default); ``(?d)``
makes ``.`` and ``$`` treat only ``\\n`` as a line end, like Python.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._col import as_col

# ---------------------------------------------------------------------------
# Headline classification rules (ordered; first match wins).
# Blanks between words stand for one or more whitespace characters.
# ---------------------------------------------------------------------------
FILING_TYPE_RULES: list[tuple[str, str]] = [
    ("annual_report", r"informe\s+anual|reporte\s+anual|annual\s+report"),
    ("financial_results", r"resultados\s+financieros|estados?\s+financieros|financial\s+results"),
    ("prospectus", r"prospecto|prospec"),
    ("public_offering", r"aviso\s+de\s+oferta|oferta\s+p[uú]blica"),
    ("shareholder_meeting", r"asamblea|junta\s+de\s+accionistas"),
    ("dividend", r"dividendo"),
    ("corporate_action", r"fusión|fusio|escisión|escisio|adquisición|adquisicio"),
    ("credit_rating", r"calificación|calificacio|rating"),
    ("auditor_change", r"cambio\s+de\s+auditor|auditor"),
    ("quarterly_report", r"reporte\s+trimestral|informe\s+trimestral|trimestre"),
    ("semi_annual_report", r"informe\s+semestral|semestre"),
    ("material_event", r"evento\s+relevante|hecho\s+relevante|material\s+event"),
    ("press_release", r"comunicado\s+de\s+prensa|press\s+release"),
    ("update", r"actualiz|update"),
]
OTHER_TYPE = "other"

# Identifiers of the filings source.
SOURCE_NAME = "cnbv"
COUNTRY = "MX"
FILING_ID_PREFIX = "cnbv_"
#: between the parts of a key-less filing's id
ID_SEPARATOR = "\x1f"

# Markers in the portal's payloads.
GRID_ROW_MARKER = "dxgvDataRow"
ROW_CALLBACK = "PerformCallback"
DX_MARKER = "/*DX*/"

#: Unicode white space
_WS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip_ws(c) -> Column:
    """Python ``str.strip()``: drop Unicode whitespace at both ends."""
    return F.btrim(as_col(c), F.lit(_WS))


def classify_filing_type(headline, rules: Sequence[tuple[str, str]] = FILING_TYPE_RULES) -> Column:
    """ordered keyword rules, case-insensitive search, else 'other'.

    ``rules`` is a parameter so callers can extend or replace the list.
    Null headlines classify as 'other'.
    """
    h = as_col(headline)
    expr = None
    for label, pattern in rules:
        cond = F.coalesce(h.rlike("(?iU)" + pattern), F.lit(False))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(OTHER_TYPE)) if expr is not None else F.lit(OTHER_TYPE)


# Characters that file names may not hold, and what is cut off
# at their ends.
UNSAFE_NAME_CHARS = r'[<>:"/\\|?*\x00-\x1f]'
NAME_ENDS = ". "


def sanitize_filename(name) -> Column:
    """unsafe characters and control chars to '_', then strip dots/blanks."""
    replaced = F.regexp_replace(as_col(name), UNSAFE_NAME_CHARS, "_")
    return F.btrim(replaced, F.lit(NAME_ENDS))


def ticker_key(emisora) -> Column:
    """strip Unicode whitespace and upper-case; null/blank -> null."""
    k = F.upper(strip_ws(emisora))
    return F.when(k != "", k)


def filing_id(key, headline, fecha="fecha", emisora="emisora", prefix: str = FILING_ID_PREFIX) -> Column:
    """prefix + key; without a key, prefix + a digest of the whole
    headline, the date text and the issuer, so that different filings with
    like headlines stay apart."""
    parts = [F.coalesce(as_col(c), F.lit("")) for c in (headline, fecha, emisora)]
    return F.concat(F.lit(prefix),
                    F.coalesce(F.nullif(as_col(key), F.lit("")), F.sha2(F.concat_ws(ID_SEPARATOR, *parts).cast("binary"), 256)))


# Named HTML entities met most (looked up first).
HTML_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\u00a0",
    "&aacute;": "á", "&eacute;": "é", "&iacute;": "í", "&oacute;": "ó", "&uacute;": "ú",
    "&Aacute;": "Á", "&Eacute;": "É", "&Iacute;": "Í", "&Oacute;": "Ó", "&Uacute;": "Ú",
    "&ntilde;": "ñ", "&Ntilde;": "Ñ", "&uuml;": "ü", "&Uuml;": "Ü", "&ccedil;": "ç", "&Ccedil;": "Ç",
    "&agrave;": "à", "&egrave;": "è", "&ograve;": "ò", "&acirc;": "â", "&ecirc;": "ê", "&ocirc;": "ô",
    "&iquest;": "¿", "&iexcl;": "¡", "&laquo;": "«", "&raquo;": "»", "&middot;": "·", "&copy;": "©",
    "&reg;": "®", "&deg;": "°", "&ordf;": "ª", "&ordm;": "º", "&euro;": "€", "&ndash;": "–",
    "&mdash;": "—", "&hellip;": "…", "&bull;": "•",
}


def _literal_map(pairs: dict[str, str]) -> Column:
    """A constant map as one folded expression (a map of literals would make
    every plan that holds it thousands of nodes larger)."""
    text = "\x1e".join(f"{k}\x1f{v}" for k, v in pairs.items())
    return F.str_to_map(F.lit(text), F.lit("\x1e"), F.lit("\x1f"))


#: the HTML standard's names; those without a semicolon may stand before other text
_NAMED = {f"&{n}": c for n, c in html5.items() if n.endswith(";")}
_BARE = {n: c for n, c in html5.items() if not n.endswith(";")}
_BARE_RE = "^&(" + "|".join(sorted(_BARE, key=len, reverse=True)) + ")"
#: numeric references 128-159 mean Windows-1252 characters
_CP1252 = {str(b): bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)}


def _code_point_text(n: Column) -> Column:
    """Code point -> one-character string (UTF-32 bytes decoded)."""
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def _numeric_text(t: Column) -> Column:
    """Character of a numeric reference; U+FFFD for one that names none."""
    digits = F.regexp_extract(t, r"^&#([0-9]+);?$", 1)
    hexa = F.regexp_extract(t, r"^&#[xX]([0-9a-fA-F]+);?$", 1)
    cp = F.when(hexa != "", F.conv(hexa, 16, 10)).otherwise(digits).try_cast("long")
    bad = cp.isNull() | (cp == 0) | (cp > 0x10FFFF) | cp.between(0xD800, 0xDFFF)
    return F.when((digits != "") | (hexa != ""),
                  F.when(bad, F.lit("\ufffd")).otherwise(F.coalesce(_literal_map(_CP1252)[cp.cast("string")], _code_point_text(cp))))


def html_unescape(c) -> Column:
    """Single-pass entity decoding: the text is cut into entity-like tokens,
    runs of other text and lone '&'. A token with a semicolon is looked up
    among the frequent names, then in the whole HTML table; numeric references
    give their code point; a name that may go without a semicolon is decoded
    at the front of a token; anything else stays. One pass means ``&amp;lt;``
    gives ``&lt;``. Text without '&' is returned as it is."""
    raw = as_col(c)
    often, named, bare = (_literal_map(m) for m in ({**HTML_ENTITIES, "&amp;": "&"}, _NAMED, _BARE))
    parts = F.regexp_extract_all(raw, F.lit(r"&#[0-9]++;?|&#[xX][0-9a-fA-F]++;?|&[0-9A-Za-z]++;?|[^&]++|&"), 0)

    def one(t):
        # the long alternation of names without a semicolon is for tokens that no table has
        front = F.regexp_extract(t, _BARE_RE, 1)
        loose = F.when(front != "", F.concat(bare[front], F.substring(t, F.length(front) + 2, F.length(t))))
        return F.when(t.startswith("&") & (F.length(t) > 1),
                      F.coalesce(often[t], F.when(t.startswith("&#"), _numeric_text(t)), F.when(t.endswith(";"), named[t]), loose, t)).otherwise(t)

    return F.when(F.instr(raw, "&") > 0, F.array_join(F.transform(parts, one), "")).otherwise(raw)


def html_unescape_all(columns: list[Column], clean: Callable[[Column], Column] = lambda c: c) -> Column:
    """``clean`` of each decoded column, as an array: the entity tables stand
    in the plan once, however many columns there are."""
    return F.transform(F.array(*columns), lambda c: clean(html_unescape(c)))


# What follows a tag's name up to its end: a value in quotes may hold '>'. Quotes
# may come backslash-escaped, inside callback payloads.
ATTRIBUTE_VALUE = r"""(?:\\?"[^"]*+"|\\?'[^']*+'|[^\s>]*+)"""
TAG_REST = r"(?:[^>=]++|=\s*+" + ATTRIBUTE_VALUE + r")*+>"
#: a tag, or a comment; a '<' before anything else is text
TAG_RE = r"<(?:!--(?s:.*?)-->|[A-Za-z/!?]" + TAG_REST + ")"


def other_attributes(name: str) -> str:
    """Pattern: the attributes of a tag in front of the one called ``name``."""
    return r"(?:[\s/]*+(?!" + name + r"[\s=>/])[^\s=>/]++(?:\s*+=\s*+" + ATTRIBUTE_VALUE + r")?+)*+[\s/]*+"


def strip_tags(fragment) -> Column:
    """Tags removed together with the whitespace around them (every text
    node stripped, nodes joined without a separator)."""
    return F.regexp_replace(as_col(fragment), r"(?U)\s*" + TAG_RE + r"\s*", "")


def finish_text(stripped) -> Column:
    """Entities decoded and the ends stripped, after ``strip_tags``. Callers
    with many rows put ``strip_tags`` in a column of its own first, so the
    regex runs once even though the decoder reads its input several times."""
    return strip_ws(html_unescape(as_col(stripped)))


def html_text(fragment) -> Column:
    """Text of an HTML fragment with every text node stripped and the nodes
    joined without a separator (``get_text(strip=True)``)."""
    return finish_text(strip_tags(fragment))


def page_text(html) -> Column:
    """Whole-page text: tags removed, nothing stripped (``get_text()``)."""
    return html_unescape(F.regexp_replace(as_col(html), TAG_RE, ""))


def title_text(html) -> Column:
    """Inner text of the first ``<title>``; null when there is none."""
    h = as_col(html)
    pattern = r"(?is)<title\b" + TAG_REST + r"(.*?)</title>"
    return F.when(h.rlike(pattern), html_text(F.regexp_extract(h, pattern, 1)))


def is_error_page(html, http_status=None) -> Column:
    """a page is rejected when its title mentions 'Error' or the status
    is not 200."""
    t = title_text(html)
    bad_title = F.coalesce(t.contains("Error"), F.lit(False))
    if http_status is None:
        return bad_title
    return bad_title | (F.coalesce(as_col(http_status), F.lit(0)) != 200)


def labelled_field(text, label_regex: str, default: str = "?") -> Column:
    """F16: value after a label up to the end of line, stripped; default
    when the label is absent."""
    t = as_col(text)
    pat = "(?Ud)" + label_regex + r"\s*(.+?)(?:\n|$)"
    return F.when(t.rlike(pat), strip_ws(F.regexp_extract(t, pat, 1))).otherwise(F.lit(default))


# Labels of the detail page.
DETAIL_LABELS = {"emisora": r"Emisora:", "asunto": r"Asunto\s*:?", "fecha": r"Fecha de recepción.*?:"}


def detail_fields(html) -> dict[str, Column]:
    """F16 over a detail page: issuer, subject and received-at. Jobs put
    ``page_text`` into a column first and call ``labelled_fields``, so that
    pages are read once."""
    return labelled_fields(page_text(html))


def labelled_fields(text) -> dict[str, Column]:
    """F16 over the text of a detail page."""
    t = as_col(text)
    return {name: labelled_field(t, label) for name, label in DETAIL_LABELS.items()}


# Patterns of the portal's texts.
TOKEN_PARAMETER = "enc="
PAGER_PATTERN = r"(?U)gina\s+\d+\s+de\s+(\d+)\s+\((\d+)\s+Env"


def token_from_callback(text) -> Column:
    """token after ``enc=`` in a callback payload (kept percent-encoded);
    null without the marker or without a token. A token ends at a blank, a
    quote, ``&``, ``>`` or a backslash, except that an escaped slash is part
    of it; only the short match is unescaped."""
    t = as_col(text)
    found = F.regexp_extract(t, r"(?sU)" + _quoted(DX_MARKER) + ".*?" + TOKEN_PARAMETER + r"((?:[^&\"'\s>\\]|\\/)++)", 1)
    return F.replace(F.nullif(found, F.lit("")), F.lit("\\/"), F.lit("/"))


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def pager_totals(text) -> tuple[Column, Column]:
    """(total pages, total rows) from the pager text, default (1, 0)."""
    t = as_col(text)
    pat = PAGER_PATTERN
    ok = F.coalesce(t.rlike(pat), F.lit(False))
    pages = F.regexp_extract(t, pat, 1).try_cast("bigint")
    rows = F.regexp_extract(t, pat, 2).try_cast("bigint")
    return (F.when(ok, pages).otherwise(F.lit(1)).cast("bigint"),
            F.when(ok, rows).otherwise(F.lit(0)).cast("bigint"))


def has_equity_marker(tipo, isin, marker: str) -> Column:
    """upper(strip(type)) contains the marker and the isin is not blank."""
    typ = F.upper(strip_ws(F.coalesce(as_col(tipo), F.lit(""))))
    i = strip_ws(F.coalesce(as_col(isin), F.lit("")))
    return typ.contains(marker) & (i != "")


def truthy(c) -> Column:
    """Python truthiness of an optional string: not null and not ''."""
    x = as_col(c)
    return F.coalesce(x != "", F.lit(False))
