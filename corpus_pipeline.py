"""Corpus pipeline: documents -> quality classifier -> language ID -> line
dedup -> n-gram Jaccard join -> packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before kept. All but the last return the columns of ``documents``; the last
returns the token pieces with their sequence and place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.llm.boosted_quality import score, train as train_quality
from filingflow.llm.common import crc_remainder, prepare, stored, table
from filingflow.llm.crf_language import UNKNOWN, predict, train as train_language
from filingflow.llm.graph import hinted
from filingflow.llm.line_dedup import dedup_lines
from filingflow.llm.ngram_join import jaccard_components
from filingflow.llm.packing import pack
from filingflow.llm.queries import tokenizer_file
from filingflow.operators.windows import global_row_number

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: share of a document's words that its language must have
MAJORITY = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (a score below 0.5) go.
    It learns from the labelled documents that its query learns from."""
    docs = docs.select(*COLUMNS)
    model = train_quality(docs, table(spark, sf_dir, "labels"), crc_remainder("doc_id", 3) != 1)
    return score(docs, model, out="quality_score").where("quality_score >= 0.5").select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those in which no language has
    ``MAJORITY`` of the words, go, whatever the number of languages learnt.
    Texts of languages that weren't learnt are spread over several and mostly
    fall below it. ``lang`` stays as it came."""
    docs = docs.select(*COLUMNS)
    field = train_language(docs, crc_remainder("doc_id", 4) != 2)
    out = predict(docs, field, out="lang_pred", score="lang_score")
    return out.where((F.col("lang_pred") != UNKNOWN) & (F.col("lang_score") >= MAJORITY)).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows go from the texts; a
    document of which nothing is left goes with them."""
    out = dedup_lines(docs.select(*COLUMNS)).where((F.size("removed_lines") == 0) | (F.col("text") != ""))
    return out.withColumn("n_chars", F.when(F.size("removed_lines") == 0, F.col("n_chars")).otherwise(F.length("text"))).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 the one with the
    smallest id stays. Documents without words or without an id all stay; of
    rows that repeat id and text, one. Different texts under one id are
    documents of their own (in the order of their hashes) and go only if their
    text is linked with an earlier one."""
    docs = docs.select(*COLUMNS)
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    named = docs.where("doc_id IS NOT NULL").select("doc_id", h.alias("__hash"))
    node = F.col("doc_id")
    if not named.groupBy("doc_id").agg(F.min("__hash").alias("lo"), F.max("__hash").alias("hi")).where("lo <> hi").isEmpty():
        # ids of their own, in the order of the documents' ids
        numbered = global_row_number(named.distinct(), ["doc_id", "__hash"], "__node")
        docs = stored(docs.withColumn("__hash", h).join(numbered, ["doc_id", "__hash"], "left").select(*COLUMNS, "__node"), "numbered-documents")
        node = F.col("__node")
    docs = docs.select(*COLUMNS, node.alias("__node"))
    linked = jaccard_components(docs, n=5, percent=80, id_col="__node").withColumnRenamed("doc_id", "__node").where("n_shingles > 0 AND __node IS NOT NULL")
    linked = stored(linked.groupBy("__node").agg(F.min("component_id").alias("component_id"), F.count("*").alias("n")), "components")
    gone = stored(linked.where("component_id <> __node").select("__node"), "near-copies")
    apart = F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]") & F.col("__node").isNotNull()
    kept = docs.where(apart).join(hinted(gone), "__node", "left_anti")
    twice = stored(linked.where("n > 1").select("__node"), "repeated-rows")
    if not twice.isEmpty():
        once = kept.join(hinted(twice), "__node", "left_semi").groupBy("__node").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")
        kept = kept.join(hinted(twice), "__node", "left_anti").select(*COLUMNS).union(once)
    return kept.select(*COLUMNS).union(docs.where(~apart).select(*COLUMNS))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048 tokens."""
    return pack(docs, tokenizer_file("word_bpe_49k.json"), 2048, payload={"ids_crc32": F.crc32("ids")})


STAGES = [("quality classifier", quality), ("language ID", language), ("line dedup", line_dedup), ("n-gram Jaccard join", near_copies),
          ("best-fit packing", sequences)]

#: SQL can't express trained models and the tokenizer; tests hold the stages
#: against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each stored as Parquet and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
