"""Small helper shared by the function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def ntz_lit(d) -> Column:
    """A naive ``datetime`` as a TIMESTAMP_NTZ literal built from its ISO
    text, so that neither the Python process's nor the session's time zone
    shifts it."""
    return F.lit(d.isoformat(sep=" ")).cast("timestamp_ntz")
