"""SQL fragments shared by the oracle queries (DuckDB dialect)."""

from __future__ import annotations

from filingflow.functions.text import FILING_TYPE_RULES, OTHER_TYPE


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def classify_sql(h: str) -> str:
    """CASE over the ordered rules; DuckDB's 'i' flag folds Unicode case."""
    whens = " ".join(f"WHEN regexp_matches({h}, {lit(p)}, 'i') THEN {lit(label)}"
                     for label, p in FILING_TYPE_RULES)
    return f"(CASE WHEN {h} IS NULL THEN {lit(OTHER_TYPE)} {whens} ELSE {lit(OTHER_TYPE)} END)"


def filing_id_sql() -> str:
    """F5 over the columns key, asunto, fecha and emisora."""
    parts = ", ".join(f"coalesce({c}, '')" for c in ("asunto", "fecha", "emisora"))
    return f"'cnbv_' || coalesce(nullif(key, ''), sha256(concat_ws(chr(31), {parts})))"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def unescape_sql(x: str) -> str:
    """Named entities of the test pages, then '&amp;' last (the pages carry
    no numeric references)."""
    from filingflow.functions.text import HTML_ENTITIES
    out = x
    for ent, ch in list(HTML_ENTITIES.items()) + [("&amp;", "&")]:
        out = f"replace({out}, {lit(ent)}, {lit(ch)})"
    return out


def html_text_sql(x: str) -> str:
    return strip_sql(unescape_sql(f"regexp_replace({x}, '\\s*<[^>]*>\\s*', '', 'g')"))


def iso_sql(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f')"
