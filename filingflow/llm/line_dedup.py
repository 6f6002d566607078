"""Line dedup with overlapping three-line windows.

Every run of ``window`` consecutive non-blank lines (surrounding white space
aside) is hashed to 128 bits. A window found at more than one place in the
corpus is kept where it comes first, in order of document id and line, and its
later occurrences are removed: the lines that they cover are merged per
document and dropped. Every removed line therefore stands in an earlier kept
place. Document order inside one id is by text hash, so the order is total.

The first place of a window is a grouped minimum, combined before the shuffle;
windows are then joined to the repeated ones only, and that join is one that
Spark can split where a passage is very common. Line positions are collected
per document only. Documents move once, to meet their covered lines.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare

#: lines are separated by a line feed; a carriage return before it is white space
BLANK = " \t\r\x0b\x0c"


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_windows(rows: DataFrame, window: int) -> DataFrame:
    """One row per window of non-blank lines: doc_id, text_hash, h1, h2, lines
    (positions covered), at (first of them)."""
    numbered = rows.select(
        "doc_id", "text_hash",
        F.filter(F.transform(_lines(F.col("text")), lambda x, i: F.struct(i.alias("at"), F.btrim(x, F.lit(BLANK)).alias("line"))),
                 lambda s: s["line"] != "").alias("ls"))
    spans = numbered.where(F.size("ls") >= window).select(
        "doc_id", "text_hash",
        F.explode(F.transform(F.sequence(F.lit(1), F.size("ls") - (window - 1)), lambda i: F.slice(F.col("ls"), i, window))).alias("w"))
    return spans.select("doc_id", "text_hash", F.xxhash64(F.col("w.line")).alias("h1"), F.xxhash64(F.lit(window), F.col("w.line")).alias("h2"),
                        F.col("w.at").alias("lines"), F.col("w.at")[0].alias("at"))


@F.pandas_udf(T.StringType())
def _without_lines(text: pd.Series, covered: pd.Series) -> pd.Series:
    """Texts without the lines at the covered positions; blank lines alone are nothing."""
    def cut(t, c):
        if t is None or c is None:
            return t
        gone = set(c.tolist())
        kept = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
        return kept if kept.strip(BLANK + "\n") else ""
    return pd.Series([cut(t, c) for t, c in zip(text, covered)], dtype=object)


def dedup_lines(docs: DataFrame, window: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with their columns, ``text_col`` without the lines
    covered by later occurrences of a repeated window, and a new column
    ``removed_lines`` (sorted positions, an empty array where none).

    Documents of fewer than ``window`` non-blank lines hold no window and stay
    whole; blank lines are never removed, but a text of which only blank lines
    are left becomes empty. Null and empty texts stay as they are. A null id
    comes before all others. Rows that repeat both id and text are one
    document and get the same result. An input column ``removed_lines`` is
    replaced; other columns pass through, whatever their names.
    """
    prepare(docs.sparkSession)
    text_hash = F.xxhash64(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_hash.alias("text_hash"), F.col(text_col).alias("text"))
    windows = line_windows(rows, window)
    place = F.struct("doc_id", "text_hash", "at")
    repeated = (windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                .where(F.col("first") < F.col("last")).select("h1", "h2", "first"))
    later = windows.join(repeated, ["h1", "h2"]).where(place > F.col("first"))
    covered = later.groupBy("doc_id", "text_hash").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("lines")))).alias("covered"))
    # the input's columns travel as one, so no name of theirs can clash
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), text_hash.alias("hash"))
    out = whole.join(covered, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left")
    text = F.col(f"row.`{text_col}`")
    kept = _without_lines(F.when(F.col("covered").isNotNull(), text), F.col("covered"))
    names = [c for c in docs.columns if c != "removed_lines"]
    return out.select(*[F.when(F.col("covered").isNull(), text).otherwise(kept).alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names],
                      F.coalesce(F.col("covered"), F.array().cast("array<int>")).alias("removed_lines"))
