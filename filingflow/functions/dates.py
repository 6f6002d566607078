"""Date and time functions (F1, F6, F20, F21) as Column expressions.

Dates are strings at the edges, as in the source system; no ``to_date`` is
used for normalisation because it raises on bad input under ANSI mode and
would also reject positions that are not calendar dates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._col import as_col


def normalize_date(s) -> Column:
    """ISO prefix kept; ``dd/MM/yyyy`` reordered by position (no calendar
    check); a third '/' within the first ten characters, or anything else,
    leaves the value unchanged; null and '' stay as they are."""
    x = as_col(s)
    n = F.length(x)
    iso = (n >= 10) & (F.substring(x, 5, 1) == "-") & (F.substring(x, 8, 1) == "-")
    dmy = (n >= 10) & (F.substring(x, 3, 1) == "/") & (F.substring(x, 6, 1) == "/")
    # split(x[:10], '/') must give exactly three parts
    third_slash = F.instr(F.substring(x, 7, 4), "/") > 0
    reordered = F.concat(F.substring(x, 7, 4), F.lit("-"), F.substring(x, 4, 2),
                         F.lit("-"), F.substring(x, 1, 2))
    return (F.when(x.isNull() | (x == ""), x)
             .when(iso, F.substring(x, 1, 10))
             .when(dmy & ~third_slash, reordered)
             .otherwise(x))


def iso_text(ts) -> Column:
    """Timestamp -> ISO text with microseconds (``datetime.isoformat``)."""
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def epoch_ms_text(ts) -> Column:
    """milliseconds since 1970-01-01 (naive time read as UTC) as text."""
    # Naive timestamps are read as UTC wall time (session time zone is UTC).
    t = as_col(ts).cast("timestamp_ntz").cast("timestamp")
    return F.unix_millis(t).cast("string")


def parse_ts(s) -> Column:
    """Lenient ISO parse; null when the text is not a timestamp."""
    return F.try_to_timestamp(as_col(s))


def duration_seconds(start_text, end_ts) -> Column:
    """seconds between an ISO start text and an end timestamp; null if
    the start does not parse."""
    st = parse_ts(start_text)
    return (F.unix_micros(as_col(end_ts).cast("timestamp")) - F.unix_micros(st)) / F.lit(1e6)


def age_hours(completed_text, as_of) -> Column:
    """hours from a completion text to ``as_of``; unparsable -> +inf."""
    c = parse_ts(completed_text)
    a = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    hours = (F.unix_micros(a) - F.unix_micros(c)) / F.lit(3_600_000_000.0)
    return F.coalesce(hours, F.lit(float("inf")))
