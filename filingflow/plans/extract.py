"""E3 document extraction: filings with a document -> structured JSON.

filings (P4: truthy path) joined with the documents on their path ->
extractor -> F8 repair -> nested ``from_json`` -> J7 pairing -> S13 sink.

The extractor is a parameter. The default is deterministic and native
(no Python): it emits the model-shaped JSON with the document type of F2
and the text. A custom extractor (e.g. a model client) is an
``Iterator[pd.DataFrame] -> Iterator[pd.DataFrame]`` function run with
``mapInPandas`` over (source_file, content) batches; set-up then happens once
per partition, not per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.docs import file_suffix, with_model_json
from ..functions.text import classify_filing_type, truthy
from ..session import arrow_batches, reliable_checkpoint, ship_package

Extractor = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

EXTRACTED_SCHEMA = (
    "document_type string, issuer string, dates map<string,string>, "
    "parties array<struct<name:string,role:string>>, "
    "amounts array<struct<value:string,currency:string,description:string>>, "
    "key_terms array<string>, summary string, raw_text string, _parse_error boolean")
DEFAULT_MODEL = "native-default"
#: documents, and bytes of them, that an extractor gets at once
EXTRACTOR_ROWS, EXTRACTOR_BYTES = 200, 4 << 20


def default_model_text(text: Column) -> Column:
    """The default extractor's output for a document text."""
    return F.to_json(F.struct(
        classify_filing_type(text).alias("document_type"),
        F.lit(None).cast("string").alias("issuer"),
        F.create_map().cast("map<string,string>").alias("dates"),
        F.array().cast("array<struct<name:string,role:string>>").alias("parties"),
        F.array().cast("array<struct<value:string,currency:string,description:string>>").alias("amounts"),
        F.array().cast("array<string>").alias("key_terms"),
        F.lit(None).cast("string").alias("summary"),
        text.alias("raw_text")), {"ignoreNullFields": "false"})


#: suffixes whose bytes are text; pdf counts where its text has been extracted
TEXT_SUFFIXES = (".txt", ".md", ".html", ".htm", ".json", ".csv", ".xml", "")


def is_text_file(path: Column) -> Column:
    """F18 dispatch: whether a file's bytes may be decoded as text. Archives,
    sheets, images and pdf files are never read as text; they are skipped and
    counted (``document_tallies``)."""
    return file_suffix(path).isin(*TEXT_SUFFIXES)


def run_extractor(docs: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """(source_file, content) -> (source_file, model_text)."""
    if extractor is None:
        content = F.col("content")
        text = F.decode(content, "UTF-8") if dict(docs.dtypes)["content"] == "binary" else content
        return docs.select("source_file", default_model_text(text).alias("model_text"))
    ship_package(docs.sparkSession)
    return docs.select("source_file", "content").mapInPandas(extractor, "source_file string, model_text string")


def extracted(docs: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """``run_extractor``, persisted. An extractor holds a batch several times
    (texts, answers, both as Arrow), so its batches are small: a worker's
    memory follows them, not the table."""
    with arrow_batches(docs.sparkSession, EXTRACTOR_ROWS, EXTRACTOR_BYTES):
        return reliable_checkpoint(run_extractor(docs, extractor))


_EMPTY_OBJECT = r"(?U)^\s*(?:```(?:[^\n]*\n)?)?\s*(?:json)?\s*\{\s*\}\s*(?:```)?\s*$"


def parse_extraction(df: DataFrame, text_col: str = "model_text") -> DataFrame:
    """F8 + nested parse: adds ``extracted`` (struct) and ``extracted_json``.
    Unparsable text becomes {raw_text: text, _parse_error: true}."""
    df = with_model_json(df, text_col, "_js", "_err")
    fallback = F.to_json(F.struct(F.col(text_col).alias("raw_text"), F.lit(True).alias("_parse_error")))
    out_json = F.when(F.col("_err"), fallback).otherwise(F.col("_js"))
    df = df.withColumn("extracted_json", out_json)
    # an empty object counts as "nothing extracted" (J7 drops it). Tested on
    # the model text itself: {} after the same clean-up steps as F8 (fence
    # line, closing fence, leading 'json', whitespace). It must not refer to
    # the parse columns, or the J7 filter pushed below this projection would
    # inline the whole validity expression.
    df = df.withColumn("extraction_empty", F.coalesce(F.col(text_col).rlike(_EMPTY_OBJECT), F.lit(False)))
    parsed = F.from_json(F.col("extracted_json"), EXTRACTED_SCHEMA)
    return df.withColumn("extracted", parsed.withField("_parse_error", F.col("_err"))).drop("_js", "_err")


def process_filings(filings: DataFrame, documents: DataFrame, extractor: Extractor | None = None,
                    path_col: str = "pdf_path", accepts: Callable[[Column], Column] = is_text_file) -> DataFrame:
    """P4 filter and F18 dispatch (``accepts``: the paths that the extractor
    takes; text files by default), extraction of each processable filing's document, J7
    pairing (filings whose extraction is empty are dropped). Output:
    filing struct, source_file, extracted struct, extracted_json."""
    todo = filings.filter(truthy(F.col(path_col)) & accepts(F.col(path_col)))
    docs = documents.join(todo.select(F.col(path_col).alias("source_file")).distinct(), "source_file", "left_semi")
    # Extraction output is persisted (reliable checkpoint in the shared
    # folder): a model call is the expensive step and must not be repeated
    # when a later stage is retried; it also keeps the parse/filter stages
    # from re-deriving the extractor expression.
    raw = extracted(docs, extractor)
    ext = parse_extraction(raw)
    ext = ext.filter(~F.col("extraction_empty")).drop("extraction_empty")
    j = todo.join(ext, todo[path_col] == ext["source_file"], "inner")
    return j.select(
        F.struct(*[F.col(c) for c in ("fecha", "emisora", "asunto", "key") if c in filings.columns]).alias("filing"),
        "source_file", "extracted", "extracted_json", *[c for c in filings.columns if c not in
                                                        ("fecha", "emisora", "asunto", "key", path_col)])


def document_tallies(filings: DataFrame, processed: DataFrame, path_col: str = "pdf_path") -> DataFrame:
    """Total filings, those with a document, processed documents, and
    documents skipped because they aren't text."""
    has, skip = truthy(F.col(path_col)), truthy(F.col(path_col)) & ~is_text_file(F.coalesce(F.col(path_col), F.lit("")))
    marks = (filings.select(has.alias("p"), F.lit(False).alias("d"), skip.alias("s"))
                    .unionByName(processed.select(F.lit(False).alias("p"), F.lit(True).alias("d"), F.lit(False).alias("s"))))
    return marks.agg(F.count_if(~F.col("d")).alias("total_filings"), F.count_if("p").alias("processable"),
                     F.count_if("d").alias("total_processed"), F.count_if("s").alias("skipped"))


def extract_single_file(spark, path: str, extractor: Extractor | None = None) -> DataFrame:
    """One document file -> {source, extracted} (same job, one path)."""
    from ..sources.files import binary_files
    docs = binary_files(spark, path).select(F.col("path").alias("source_file"), "content")
    ext = parse_extraction(extracted(docs, extractor))
    return ext.select(F.col("source_file").alias("source"), "extracted")
