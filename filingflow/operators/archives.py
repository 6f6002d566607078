"""Archive and page operators.

G7 needs a zip reader, which Spark lacks: it runs as ``mapInPandas`` over a
binary column (one archive per row, Arrow batches), so archives are spread
over tasks by the scan and no archive is collected anywhere else. Members are
emitted in sorted path order; unsupported suffixes are skipped; a corrupt
archive yields nothing.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .windows import group_row_number

# Member suffixes the document extraction accepts.
PDF_SUFFIXES = (".pdf",)
SHEET_SUFFIXES = (".xls", ".xlsx")
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg", ".tiff", ".bmp")
KEPT_SUFFIXES = PDF_SUFFIXES + SHEET_SUFFIXES + IMAGE_SUFFIXES

MEMBER_SCHEMA = "archive string, member string, suffix string, member_pos int, n_bytes long, content binary"


def _suffix(name: str) -> str:
    base = name.rsplit("/", 1)[-1]
    if "." not in base.lstrip("."):
        return ""
    return "." + base.rsplit(".", 1)[-1].lower()


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """An archive at a time: all of its members, or none if any is damaged,
    encrypted or packed in an unknown way."""
    for pdf in batches:
        for archive, content in zip(pdf["archive"], pdf["content"]):
            out = []
            try:
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as zf:
                    names = sorted((i.filename for i in zf.infolist() if not i.is_dir()), key=lambda n: n.split("/"))
                    for name in names:
                        if _suffix(name) in KEPT_SUFFIXES:
                            data = zf.read(name)
                            out.append((archive, name, _suffix(name), len(out), len(data), data))
            except (zipfile.BadZipFile, zlib.error, OSError, EOFError, RuntimeError, NotImplementedError):
                continue
            if out:
                yield pd.DataFrame(out, columns=["archive", "member", "suffix", "member_pos", "n_bytes", "content"])


def zip_members(archives: DataFrame, archive_col: str = "archive", content_col: str = "content") -> DataFrame:
    """(archive, content) rows -> one row per kept member."""
    from ..session import ship_package
    ship_package(archives.sparkSession)
    src = archives.select(F.col(archive_col).cast("string").alias("archive"),
                          F.col(content_col).alias("content"))
    return src.mapInPandas(_members, MEMBER_SCHEMA)


def first_pages(pages: DataFrame, doc_cols: list[str], page_col: str, max_pages: int) -> DataFrame:
    """The first ``max_pages`` pages of every document (0 = all),
    numbered in page order. ``row_number() <= n`` is planned as a group
    limit that also runs before the shuffle, so a document with many pages
    is cut map-side."""
    if max_pages <= 0:
        # all pages: numbering without a per-document window (hot documents
        # are split by the range partitioning of the global numbering)
        return group_row_number(pages, doc_cols, [page_col], "page_no").withColumn(
            "page_no", F.col("page_no").cast("int"))
    w = Window.partitionBy(*doc_cols).orderBy(page_col)
    return pages.withColumn("page_no", F.row_number().over(w)).filter(F.col("page_no") <= max_pages)
