"""The pipeline's stages against plain versions of their work, at the
smallest scale and on odd rows."""

import collections
import os
import sys

import numpy as np
import pyarrow as pa
import zlib

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import brute  # noqa: E402
import corpus_pipeline as C  # noqa: E402

from filingflow.llm import boosted_quality as Q  # noqa: E402
from filingflow.llm import crf_language as L  # noqa: E402
from filingflow.llm.common import crc_remainder, prepare, stored, table  # noqa: E402
from filingflow.llm.queries import tokenizer_file  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    prepare(spark)
    docs = table(spark, SF, "documents").union(spark.createDataFrame(
        [(9001, None, "en", "s", 0), (9002, "", None, None, None), (9003, "...", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long"))
    columns = docs.columns
    for name, stage in C.STAGES:
        before = [r.asDict() for r in docs.collect()]
        docs = stored(stage(spark, docs, SF), "test-stage")
        after = docs.collect()
        texts = {r["doc_id"]: r["text"] for r in before}
        if name != "best-fit packing":
            assert docs.columns == columns
        if name == "quality classifier":
            model = Q.train(spark.createDataFrame(before, docs.schema), table(spark, SF, "labels"), crc_remainder("doc_id", 3) != 1)
            score = model.scores(Q.statistics(pa.array([r["text"] or "" for r in before])))
            assert {r.doc_id for r in after} == {r["doc_id"] for r, s in zip(before, score) if s >= 0.5}
            bad = {r.doc_id for r in table(spark, SF, "labels").where("quality = 0").collect()}
            assert len(bad & {r.doc_id for r in after}) <= 0.1 * len(bad)
        elif name == "language ID":
            field = L.train(spark.createDataFrame(before, docs.schema), crc_remainder("doc_id", 4) != 2)
            langs, score = L.predict_block(field, pa.array([r["text"] or "" for r in before]))
            assert {r.doc_id for r in after} == {r["doc_id"] for r, x, s in zip(before, langs, score) if x != "und" and s >= C.MAJORITY}
            assert not {9001, 9002, 9003} & {r.doc_id for r in after}
        elif name == "line dedup":
            want = brute.dedup_lines(list(texts.items()))
            assert {r.doc_id: r.text for r in after} == {k: t for k, (t, gone) in want.items() if not gone or t}
        elif name == "n-gram Jaccard join":
            want = brute.components(list(texts.items()), 5, 80)
            assert sorted(r.doc_id for r in after) == sorted(k for k, (_, c) in want.items() if c == k)
            assert all(texts[r.doc_id] == r.text for r in after)
        else:
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
            want, filled = {}, collections.defaultdict(list)
            for k, text in texts.items():
                ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
                for i, a in enumerate(range(0, len(ids), 2048)):
                    want[k, i] = (a, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].tobytes()))
            assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in after} == want
            for r in after:
                filled[r.sequence_id].append((r.offset, r.length))
            assert all(sum(n for _, n in s) <= 2048 and min(s)[0] == 0 for s in filled.values())


def test_repeated_rows(spark):
    rows = [(1, "a b c d e f g", "en", "s", 1), (1, "a b c d e f g", "en", "s", 1), (2, "A b c d e f g", "en", "s", 1), (3, None, None, None, None),
            (3, None, None, None, None), (None, "a b c d e f g", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = C.near_copies(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == [(0, "a b c d e f g"), (1, "a b c d e f g"), (3, ""), (3, "")]
    assert C.near_copies(spark, docs.limit(0), SF).count() == 0


def test_language_stage_rejects(spark):
    """Learnt from real documents: theirs stay, also the held-out ones; foreign
    and mixed texts go."""
    docs = prepare(spark) and table(spark, "/root/testdata/sf0.01", "documents")
    plain = {r.doc_id for r in docs.where("lang IS NOT NULL AND text IS NOT NULL").collect()}
    foreign = ["Привет как дела сегодня мы идем в магазин за хлебом", "これは 日本 語 の 文章 です また 会い ましょう", "xkcd qwzx jjkl pppp zzzq vvvk bnmq wqwq",
               "안녕하세요 오늘은 날씨가 아주 좋습니다 그래서 산책을 갑니다", "καλημέρα σας πώς είστε σήμερα πάμε στην αγορά"]
    firsts = {r.lang: r.text.split()[:40] for r in docs.where("lang IS NOT NULL AND length(text) BETWEEN 300 AND 5000").orderBy("doc_id").collect()}
    mixed = [" ".join(w for words in zip(*firsts.values()) for w in words)]  # word by word, as no code-switched text does
    extra = [(900_000 + i, t, None, "s", len(t)) for i, t in enumerate(foreign + mixed)]
    got = {r.doc_id for r in C.language(spark, docs.select(*C.COLUMNS).union(spark.createDataFrame(extra, docs.select(*C.COLUMNS).schema)), "").collect()}
    rejected = [i for i, *_ in extra if i not in got]
    print(f"rejected: {len(plain - got)} of {len(plain)} documents of a learnt language, {len(rejected)} of {len(extra)} planted ones")
    assert len(plain - got) <= 0.005 * len(plain) and len(rejected) >= len(extra) - 1


def test_different_texts_under_one_id_stay(spark):
    """Texts that share nothing but their id are documents of their own; a near
    copy goes, whichever id it has."""
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long, "en", "s", 1), (1, "quite another text of some eight plain words", "en", "s", 2), (1, long, "en", "t", 3), (7, long + " more", "en", "s", 4),
            (7, "a third text under the same id seven here", None, "s", 5), (None, long, "en", "s", 6), (8, "", "en", "s", 7), (8, None, "en", "s", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = C.near_copies(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted([
        (0, long), (1, long), (1, rows[1][1]), (7, rows[4][1]), (8, ""), (8, "")])
    assert [r.source for r in got if r.doc_id == 1 and r.text == long] == ["s"]
