"""JSON, file-name and download functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._col import as_col
from .text import sanitize_filename, strip_ws

# File name extensions kept as they are, and fallbacks.
KNOWN_EXTENSIONS = (".pdf", ".xls", ".xlsx", ".doc", ".docx", ".zip")
DEFAULT_DOCUMENT_NAME = "document.pdf"
PDF_MAGIC = "%PDF"
ATTACHED_LABEL = r"Archivo adjunto:"


def to_json_text(*cols: Column) -> Column:
    """row -> JSON text with nulls kept."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def repair_fenced_json(text) -> Column:
    """F8 (text part): the candidate JSON text after the fallback clean-up:
    strip; drop an opening fence with the rest of its line (or just the
    fence when there is no newline); drop one closing fence at the very end;
    strip; drop a leading 'json'; strip. Each step rewrites the previous one
    once, so the expression stays linear in size."""
    c = strip_ws(as_col(text))
    c = F.regexp_replace(c, r"^```(?:[^\n]*\n)?", "")
    c = F.regexp_replace(c, r"```\z", "")
    c = strip_ws(c)
    c = F.regexp_replace(c, r"^json", "")
    return strip_ws(c)


# The tokens of JSON text (with the non-finite numbers that the
# source system's parser takes too), behind JSON white space.
_JSON_TOKEN = (r'[ \t\r\n]*+("(?:[^"\\\x00-\x1f]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+"'
               r"|-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+|-?Infinity|NaN|true|false|null|(?s:.))")
_STACK = "struct<stack:string,state:string>"


def _token_class(t: Column) -> Column:
    """s: string, v: other scalar, x: no token; punctuation stands for itself."""
    return (F.when(t.isin(*"{}[]:,"), t).when(t.startswith('"'), F.when(F.length(t) > 1, F.lit("s")).otherwise(F.lit("x")))
             .when(t.rlike("^(?:-?[0-9].*|true|false|null|NaN|-?Infinity)$"), F.lit("v")).otherwise(F.lit("x")))


def is_json(text) -> Column:
    """Whole-text JSON validity, by a pushdown automaton over the tokens: the
    stack holds the open brackets, the state says what may come next (V a
    value, F a value or ']', K a key or '}', k a key, C a colon, E what follows
    a value, X nothing: an error)."""
    t = strip_ws(as_col(text))
    tokens = F.transform(F.regexp_extract_all(t, F.lit(_JSON_TOKEN), 1), _token_class)

    def step(acc, c):
        stack, state = acc["stack"], acc["state"]
        top = F.right(stack, F.lit(1))
        value = state.isin("V", "F")
        opens = value & c.isin("{", "[")
        after = state == "E"
        closes = ((c == "}") & ((state == "K") | after & (top == "{"))) | ((c == "]") & ((state == "F") | after & (top == "[")))
        then = (F.when(opens, F.when(c == "{", "K").otherwise("F")).when(closes, "E")
                 .when(value & c.isin("s", "v"), "E").when(state.isin("K", "k") & (c == "s"), "C").when((state == "C") & (c == ":"), "V")
                 .when(after & (c == ",") & (top == "{"), "k").when(after & (c == ",") & (top == "["), "V").otherwise("X"))
        return F.struct(F.when(opens, F.concat(stack, c)).when(closes, F.substring(stack, F.lit(1), F.length(stack) - 1)).otherwise(stack).alias("stack"),
                        then.alias("state")).cast(_STACK)

    start = F.struct(F.lit("").alias("stack"), F.lit("V").alias("state")).cast(_STACK)
    return F.coalesce(F.aggregate(tokens, start, step, lambda acc: (acc["state"] == "E") & (acc["stack"] == "")), F.lit(False))


def parse_model_json(text) -> tuple[Column, Column]:
    """F8: (json_text, parse_error). The text as is when it parses, else the
    cleaned text when that parses, else null with parse_error = true."""
    t = as_col(text)
    cleaned = repair_fenced_json(t)
    ok_raw = is_json(t)
    ok_clean = is_json(cleaned)
    js = F.when(ok_raw, t).when(ok_clean, cleaned)
    return js, js.isNull()


def with_model_json(df, text_col: str, json_col: str = "model_json", err_col: str = "parse_error"):
    """F8 as DataFrame steps: the cleaned text and both validity tests are
    columns of their own, so the repair expression is evaluated once per row
    instead of being inlined into every test (which also keeps the generated
    code small enough for whole-stage codegen)."""
    t = F.col(text_col)
    df = (df.withColumn("_mj_clean", repair_fenced_json(t))
            .withColumn("_mj_raw_ok", is_json(t))
            .withColumn("_mj_clean_ok", is_json(F.col("_mj_clean"))))
    js = F.when(F.col("_mj_raw_ok"), t).when(F.col("_mj_clean_ok"), F.col("_mj_clean"))
    return (df.withColumn(json_col, js).withColumn(err_col, F.col(json_col).isNull())
              .drop("_mj_clean", "_mj_raw_ok", "_mj_clean_ok"))


def top_level_field_count(json_text) -> Column:
    """Number of top-level keys of a JSON object text."""
    return F.size(F.json_object_keys(as_col(json_text)))


def percent_decode(name) -> Column:
    """percent-decoding as ``urllib.parse.unquote``: runs of valid %XX
    escapes are decoded as UTF-8 (malformed bytes -> U+FFFD), everything else
    -- '+', stray or invalid '%' -- is kept as it is. The text is cut into
    runs of escapes, other text and lone '%'; only escape runs are decoded."""
    n = as_col(name)
    parts = F.regexp_extract_all(n, F.lit(r"(?:%[0-9A-Fa-f]{2})++|[^%]++|%"), 0)
    decoded = F.transform(parts, lambda t: F.when(t.startswith("%") & (F.length(t) >= 3),
                                                  F.url_decode(t)).otherwise(t))
    return F.when(n.isNotNull(), F.array_join(decoded, ""))


def has_known_extension(name) -> Column:
    low = F.lower(as_col(name))
    cond = None
    for ext in KNOWN_EXTENSIONS:
        c = low.endswith(ext)
        cond = c if cond is None else (cond | c)
    return cond


def is_pdf_response(content_type, head_bytes) -> Column:
    """F11 (pdf test): content type mentions pdf or the body starts %PDF."""
    ct = F.coalesce(as_col(content_type), F.lit(""))
    head = F.coalesce(as_col(head_bytes), F.lit(""))
    return F.lower(ct).contains("pdf") | (F.substring(head, 1, 4) == PDF_MAGIC)


def is_file_response(content_type) -> Column:
    """F11 (file test): an ``application/`` type that is not html."""
    ct = F.coalesce(as_col(content_type), F.lit(""))
    return ct.contains("application/") & ~F.lower(ct).contains("html")


def attached_name(page_text_col, hint) -> Column:
    """attached-name label of the detail page, else the hint, else the
    default document name."""
    t = as_col(page_text_col)
    pat = "(?Ud)" + ATTACHED_LABEL + r"\s*(.+?)(?:\n|$)"
    label = F.when(t.rlike(pat), strip_ws(F.regexp_extract(t, pat, 1)))
    return F.coalesce(label, F.nullif(as_col(hint), F.lit("")), F.lit(DEFAULT_DOCUMENT_NAME))


def name_hint(emisora, asunto) -> Column:
    """``issuer_subject.pdf``."""
    return F.concat(F.coalesce(as_col(emisora), F.lit("")), F.lit("_"),
                    F.coalesce(as_col(asunto), F.lit("")), F.lit(".pdf"))


def resolve_file_name(content_disposition, attached, is_pdf) -> Column:
    """name from ``filename=`` of the disposition (quotes stripped,
    percent-decoded), else the attached name sanitised with .pdf/.bin added
    unless it has a known extension; the result is sanitised again."""
    cd = F.coalesce(as_col(content_disposition), F.lit(""))
    pat = r"(?Ud)filename=(.+?)(?:;|$)"
    from_cd = percent_decode(F.btrim(F.regexp_extract(cd, pat, 1), F.lit("\"' ")))
    base = sanitize_filename(as_col(attached))
    with_ext = F.when(has_known_extension(base), base).otherwise(
        F.concat(base, F.when(as_col(is_pdf), F.lit(".pdf")).otherwise(F.lit(".bin"))))
    chosen = F.when(cd.rlike(pat), from_cd).otherwise(with_ext)
    return sanitize_filename(chosen)


def file_suffix(path) -> Column:
    """Lower-case suffix of the last path segment, '' when there is none."""
    return F.lower(F.regexp_extract(as_col(path), r"(\.[^./]+)$", 1))


def suffix_kind(path) -> Column:
    """pdf / spreadsheet / zip / unsupported by suffix."""
    s = file_suffix(path)
    return (F.when(s == ".pdf", F.lit("pdf"))
             .when(s.isin(".xls", ".xlsx"), F.lit("spreadsheet"))
             .when(s == ".zip", F.lit("zip"))
             .otherwise(F.lit("unsupported")))

