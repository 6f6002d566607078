"""The queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_remainder, prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


def tokenizer_file(name: str) -> str:
    """A public vocabulary file; FF_TOKENIZERS names another folder."""
    folder = os.environ.get("FF_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_warc")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written into WARC archives and read back."""
    from .warc import round_trip
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_suffix_tree")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents scored by a suffix tree learnt from nine tenths of them."""
    from .suffix_tree import score_documents
    return score_documents(table(spark, sf_dir, "documents"), crc_remainder("doc_id", 10) == 0)


@query("op3_boosted_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of documents by trees learnt from two thirds of the labels."""
    from .boosted_quality import score, train
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), crc_remainder("doc_id", 3) != 1)
    out = score(docs, model)
    return out.select("doc_id", (crc_remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_crf_language")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of documents by a field learnt from three quarters of them."""
    from .crf_language import predict, train
    docs = table(spark, sf_dir, "documents")
    field = train(docs, crc_remainder("doc_id", 4) != 2)
    out = predict(docs.select("doc_id", "text"), field)
    return out.select("doc_id", (crc_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens."""
    from .packing import pack
    packed = pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 2048, payload={"ids_crc32": F.crc32("ids")})
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OP6_SQL = f"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS g FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 90 * (x.n + y.n - k)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT t.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(t.doc_id, coalesce(min(r.b), t.doc_id)) AS component_id
FROM t LEFT JOIN n ON n.doc_id = t.doc_id LEFT JOIN r ON r.a = t.doc_id GROUP BY t.doc_id
"""


@query("op6_ngram_jaccard", _OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by three-word shingles at 0.9."""
    from .ngram_join import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


_OP7_SQL = """
WITH c AS (SELECT DISTINCT vec_id, list_sum([CASE WHEN embedding[i] > 0 THEN (1::HUGEINT << (i - 1)::INTEGER) ELSE 0::HUGEINT END
                                             for i in range(1, len(embedding) + 1)])::UBIGINT AS code
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
p AS (SELECT q.vec_id AS query_id, r.vec_id AS vec_id, min(bit_count(xor(q.code, r.code)::BIT)) AS distance
      FROM c q JOIN c r ON q.vec_id <> r.vec_id WHERE q.vec_id % 100 = 0 GROUP BY 1, 2)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INTEGER AS rank, vec_id, distance::INTEGER AS distance
FROM p QUALIFY rank <= 10
"""


@query("op7_multi_index_hash", _OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of every hundredth vector, exactly."""
    from .multi_index_hash import nearest_codes, sign_code
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), sign_code(F.col("embedding")).alias("code"))
    found = nearest_codes(rows, rows.where("id % 100 = 0"), 10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


@query("op8_adaptive_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth one."""
    from .adaptive_scan import nearest_vectors
    return nearest_vectors(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents encoded and decoded with the merge-type piece vocabulary."""
    from .sentencepiece_bpe import encode_decode
    out = encode_decode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


#: lines are joined by a line feed that no line holds; a window is three of them
_OP10_SQL = """
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM d),
f AS (SELECT doc_id, text, pos, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM l
      WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
w AS (SELECT doc_id, pos, line AS a, lead(line, 1) OVER o AS b, lead(line, 2) OVER o AS c, lead(pos, 1) OVER o AS pos1, lead(pos, 2) OVER o AS pos2
      FROM f WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
v AS (SELECT *, first_value(doc_id) OVER k AS d0, first_value(pos) OVER k AS p0
      FROM w WHERE c IS NOT NULL WINDOW k AS (PARTITION BY a, b, c ORDER BY doc_id, pos)),
r AS (SELECT doc_id, unnest([pos, pos1, pos2]) AS pos FROM v WHERE (doc_id, pos) > (d0, p0)),
c AS (SELECT DISTINCT doc_id, pos FROM r),
k AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE c.pos IS NULL) AS kept, count(c.pos) AS removed
      FROM l LEFT JOIN c ON l.doc_id = c.doc_id AND l.pos = c.pos GROUP BY l.doc_id)
SELECT doc_id, removed::INTEGER AS n_removed,
       CASE WHEN removed > 0 AND trim(coalesce(kept, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN '' ELSE kept END AS text
FROM k
"""


@query("op10_line_dedup", _OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines of repeated three-line windows."""
    from .line_dedup import dedup_lines
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("removed_lines").alias("n_removed"), F.coalesce("text", F.lit("")).alias("text"))


@query("op11_word_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of documents, some of which are made to loop."""
    from .word_runs import word_runs
    found = word_runs(table(spark, sf_dir, "documents"), loop=F.crc32(F.col("doc_id").cast("string").cast("binary")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = found.withColumn("best", longest)
    return best.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
                       (-F.col("best.period")).alias("period"),
                       F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
                       F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).cast("binary"), 256).alias("runs_sha256"),
                       F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query("op12_cholesky_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings projected on their first eight whitening components."""
    from .whitening import whiten
    out = whiten(table(spark, sf_dir, "embeddings"), components=8)
    each = out.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
                       F.col("c.explained").alias("explained"), "identity_error")


@query("op13_flow_resharding")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents resharded from 16 shards to 24 of near-equal bytes."""
    from .resharding import reshard, size_of
    text = F.col("row.text")
    out = reshard(table(spark, sf_dir, "documents"), shards=24, columns={
        "doc_id": F.col("row.doc_id"), "size": size_of(text), "text_crc32": F.crc32(F.coalesce(text, F.lit("")).cast("binary"))})
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
