"""Suffix tree, quality, language, line dedup, n-gram join, packing,
sentencepiece: against plain versions, and on odd tables."""

import collections
import math
import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from filingflow.llm import boosted_quality as Q  # noqa: E402
from filingflow.llm import crf_language as L  # noqa: E402
from filingflow.llm import ngram_join as J  # noqa: E402
from filingflow.llm import packing as P  # noqa: E402
from filingflow.llm import suffix_tree as S  # noqa: E402
from filingflow.llm.common import blocks, crc_remainder, words_of  # noqa: E402
from filingflow.llm.line_dedup import dedup_lines  # noqa: E402
from filingflow.llm.queries import tokenizer_file  # noqa: E402
from filingflow.llm.sentencepiece_bpe import codec, encode_decode  # noqa: E402

ODD_TEXTS = [None, "", " ", "\n\t \n", "One", "one TWO", "a b c d e f", "a b c d e f", "Ünï cödé ß — 日本語 😀", "x\x1cy\x85z　w",
             "w" * 5000, "the cat " * 3000, "don't <|endoftext|> it's", "  lead and  double  ", "▁mark ▁▁ here", "1234 $$$ ### !!"]
#: names that operators use themselves, as columns of the input
CLASH = "doc_id long, text string, score double, component_id long, ids string, block long, code int, removed_lines string, lang string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, 0.5, 1, "i", 2, 3, "r", "en" if i % 2 else None) for i, t in enumerate(ODD_TEXTS)]
    rows += [(6, ODD_TEXTS[6], 0.5, 1, "i", 2, 3, "r", None), (None, "a b c d e f", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, CLASH)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLASH)


def test_words_and_blocks():
    texts = pa.array([t or "" for t in ODD_TEXTS])
    codes, distinct, offsets = words_of(texts)
    d = distinct.to_pylist()
    got = [[d[c] for c in codes[a:b]] for a, b in zip(offsets, offsets[1:])]
    assert got == [brute.words(t) for t in ODD_TEXTS]
    batches = [pa.RecordBatch.from_arrays([pa.array(["x" * n for n in sizes], pa.string())], names=["t"]) for sizes in ([5, 50, 5], [], [300, 1, 1], [2])]
    cut = [b.column("t").to_pylist() for b in blocks(iter(batches), "t", 40)]
    assert [x for b in cut for x in b] == ["x" * n for n in (5, 50, 5, 300, 1, 1, 2)]
    assert all(sum(map(len, b[:-1])) < 40 for b in cut)


# --- suffix tree -------------------------------------------------------------

def test_tree_is_a_distribution():
    rng = np.random.default_rng(3)
    seqs = [rng.integers(1, 6, rng.integers(1, 30)) for _ in range(80)]
    flat, off = np.concatenate(seqs), np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    runs, counts = np.unique(S.class_runs(flat, off, 2), return_counts=True)
    levels = []
    for k in range(3):
        r, which = np.unique(runs & ((1 << S.BITS * (k + 1)) - 1), return_inverse=True)
        levels.append((r, np.bincount(which, weights=counts).astype(np.int64)))
    tree = S.fit(levels, 2, 0.05)
    assert len(tree.states[2]) > 0
    for context in (0, 3, (1 << S.BITS) | 2, (5 << S.BITS) | 5, 400):
        total = (10 ** tree.log10((context << S.BITS) | np.arange(S.SYMBOLS))).sum()
        assert abs(total - 1) < 1e-9


def test_runs_by_hand():
    runs = S.class_runs(np.array([7, 8, 9]), np.array([0, 2, 2, 3]), 2)
    parts = [(r >> 2 * S.BITS, r >> S.BITS & (S.SYMBOLS - 1), r & (S.SYMBOLS - 1)) for r in runs.tolist()]
    assert parts == [(0, 0, 7), (0, 7, 8), (7, 8, 0), (0, 0, 0), (0, 0, 9), (0, 9, 0)]


def test_scores(spark, odd, empty):
    held = crc_remainder("doc_id", 3) == 0
    got = [tuple(r) for r in S.score_documents(odd, held).collect()]
    assert len(got) == odd.count()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    out = {k: k is not None and zlib.crc32(str(k).encode()) % 3 == 0 for k, _ in rows}
    count = collections.Counter(w for k, t in rows if not out[k] for w in brute.words(t))
    ends = sum(not out[k] for k, _ in rows)
    n = sum(count.values()) + ends
    scale = n + 0.1 * (len(count) + 2)
    want = collections.Counter()
    for k, t in rows:
        w = brute.words(t)
        base = sum(math.log10((count[x] + 0.1) / scale) for x in w) + math.log10((ends + 0.1) / scale)
        want[k, out[k], len(w) + 1, sum(count[x] > 0 for x in w) + 1, n, round(base, 6)] += 1
    assert collections.Counter((*r[:5], round(r[5], 6)) for r in got) == want
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in got)
    assert S.score_documents(empty, held).count() == 0


def test_longer_states_as_in_the_whole_tree():
    rng = np.random.default_rng(4)
    seqs = [rng.integers(1, 4, rng.integers(1, 60)) for _ in range(120)]
    flat, off = np.concatenate(seqs), np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    every = S.class_runs(flat, off, 4)
    runs, counts = np.unique(every[:-400], return_counts=True)
    levels = []
    for k in range(5):
        r, which = np.unique(runs & ((1 << S.BITS * (k + 1)) - 1), return_inverse=True)
        levels.append((r, np.bincount(which, weights=counts).astype(np.int64)))
    whole, low = S.fit(levels, 4, 0.3, 4), S.fit(levels[:2], 1, 0.3, 4)
    assert len(whole.states[3]) and len(whole.states[4])
    asked = np.unique(every)
    n = np.zeros(len(asked))
    n[np.searchsorted(asked, runs)] = counts
    assert (n == 0).any()
    bucket = S.buckets_of(asked, 5)
    for b in range(5):
        mine = bucket == b
        assert np.allclose(S.lengthened(low, asked[mine], n[mine], 4, 0.3, 4), whole.log10(asked[mine]))
    x = np.array([0, 1, -5, 1 << 62])
    assert (S.unpacked(S.packed(x), 4) == x).all()


def test_contexts_stay_in_a_larger_corpus(spark):
    """Three classes back decide the next one, with five occurrences each,
    however much other text there is."""
    words = ["qa", "qbb", "xccc", "ydddd", "Peeeee", "Qffffff"]
    assert len(set(S.word_classes(pa.array([w.lower() for w in words] + ["w"])))) == 7
    a, b, x, y, p, q = words
    rows = [(i, f"{a} {x} {y} {p}" if i % 2 else f"{b} {x} {y} {q}") for i in range(10)]
    rows += [(100, f"{a} {x} {y} {p}"), (101, f"{a} {x} {y} {q}")]
    for more in ([], [(200, "w " * 700_000)]):
        docs = spark.createDataFrame(rows + more, "doc_id long, text string")
        got = {r.doc_id: r.score for r in S.score_documents(docs, F.col("doc_id").isin(100, 101)).collect()}
        assert len(got) == len(rows + more) and got[100] - got[101] > 0.5


# --- quality -----------------------------------------------------------------

def test_statistics_by_hand():
    x = dict(zip(Q.STATISTICS, Q.statistics(pa.array(["Ab ab ab.\nAb | 1!!"]))[0]))
    assert abs(x["share_upper"] - 2 / 18) < 1e-6 and abs(x["share_bar"] - 1 / 18) < 1e-6 and abs(x["share_line"] - 1 / 18) < 1e-6
    assert x["same_word"] == 0
    assert x["longest_word"] == 3 and abs(x["top_word"] - 2 / 6) < 1e-6 and abs(x["no_letter_words"] - 2 / 6) < 1e-6
    assert (Q.statistics(pa.array(["", ""])) == 0).all() and Q.statistics(pa.array([], pa.string())).shape == (0, len(Q.STATISTICS))


def test_trees_learn_and_walk():
    rng = np.random.default_rng(1)
    x = rng.random((1500, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.6) ^ (x[:, 3] > 0.5)).astype(float)
    model = Q.fit(x[:1000], y[:1000])
    p = model.scores(x)
    assert ((p[1000:] >= 0.5) == y[1000:]).mean() > 0.97

    def walk(row):
        total = model.prior
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += leaf[node - len(f)]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(p[:50], [walk(r) for r in x[:50]])
    assert 0 < Q.fit(np.zeros((0, 5)), np.zeros(0)).scores(x)[0] < 1
    assert Q.fit(x, np.ones(len(x))).scores(x)[0] > 0.5


def test_quality_on_odd_tables(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1), (5, 1), (12, 0), (15, 0), (None, 1), (6, None), (999, 1)], "doc_id long, quality int")
    model = Q.train(odd, labels, F.lit(True))
    got = Q.score(odd, model).select("doc_id", "text", "score").collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if not r.text}
    assert len(blank) == 1  # null and empty texts alike
    assert Q.score(empty, Q.train(empty, labels.limit(0), F.lit(True))).count() == 0


# --- language ----------------------------------------------------------------

def _sequential(field, emissions):
    n, k = emissions.shape
    a, e = np.exp(field.transitions), np.exp(emissions - emissions.max(axis=1, keepdims=True))
    f, b = np.zeros((n, k)), np.ones((n, k))
    f[0] = np.exp(field.start) * e[0]
    f[0] /= f[0].sum()
    for t in range(1, n):
        f[t] = (f[t - 1] @ a) * e[t]
        f[t] /= f[t].sum()
    for t in range(n - 2, -1, -1):
        b[t] = a @ (e[t + 1] * b[t + 1])
        b[t] /= b[t].sum()
    p = f * b
    return p / p.sum(axis=1, keepdims=True)


def test_marginals_cross_segments():
    rng = np.random.default_rng(2)
    field = L.LanguageField(["a", "b", "c"], np.empty(0, np.uint64))
    field.transitions, field.start = rng.normal(size=(3, 3)), rng.normal(size=3)
    sizes = [1, 64, 65, 0, 200, 3, 128]
    emissions = rng.normal(size=(sum(sizes), 3)) * 2
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    got = field.marginals(emissions, offsets)
    for a, b in zip(offsets, offsets[1:]):
        if b > a:
            assert np.allclose(got[a:b], _sequential(field, emissions[a:b]))
    # and by enumeration of all paths
    e = emissions[:0].reshape(0, 3)
    x = emissions[-5:]
    weights = collections.Counter()
    import itertools
    for path in itertools.product(range(3), repeat=5):
        s = field.start[path[0]] + sum(x[i, p] for i, p in enumerate(path)) + sum(field.transitions[p, q] for p, q in zip(path, path[1:]))
        for i, p in enumerate(path):
            weights[i, p] += math.exp(s)
    total = sum(weights[0, p] for p in range(3))
    want = np.array([[weights[i, p] / total for p in range(3)] for i in range(5)])
    assert np.allclose(field.marginals(x, np.array([0, 5])), want) and field.marginals(e, np.array([0])).shape == (0, 3)


def _field(words, labels=4, seed=3):
    rng = np.random.default_rng(seed)
    field = L.LanguageField([f"l{i}" for i in range(labels)], np.sort(L.hashes_of(pa.array(words))))
    field.weights = rng.normal(size=field.weights.shape).astype(np.float32)
    field.transitions = rng.normal(size=(labels, labels))
    return field


def _peak_mb(work):
    import tracemalloc
    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak


def test_languages_of_a_block_in_runs(monkeypatch):
    rng = random.Random(8)
    words = ["ka", "kolo", "12", "brim", "été", "x1"]
    texts = pa.array([" ".join(rng.choices(words, k=k)) for k in (0, 3, 64, 65, 700, 0, 1, 130, 20, 0)])
    field = _field(words[:3])
    whole = L.predict_block(field, texts)
    for cells in (1, 4 * 64 * 3, 4 * 64 * 20):
        monkeypatch.setattr(L, "CELLS", cells)
        monkeypatch.setattr(L, "WORDS", 2)
        langs, scores = L.predict_block(field, texts)
        assert langs == whole[0] and np.allclose(scores, whole[1], atol=1e-12)
    assert whole[0][0] == whole[0][-1] == "und" and L.predict_block(field, pa.array(["", "12", ""]))[0] == ["und"] * 3


def test_memory_of_a_block_of_languages():
    """What a worker holds besides a block follows neither the number of short texts nor that of words."""
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(40_000)]
    field = _field(words[:100])
    short, long_ = pa.array(rng.choices(words[:500], k=150_000)), pa.array([" ".join(rng.choices(words[:500], k=400)) for _ in range(900)])
    many = pa.array([" ".join(words[i:i + 400]) for i in range(0, len(words), 400)])
    assert [_peak_mb(lambda t=t: L.predict_block(field, t)) < limit for t, limit in ((short, 40), (long_, 45), (many, 20))] == [True] * 3


def test_training_words_and_features_in_parts(monkeypatch):
    rng = random.Random(10)
    texts = pa.array([" ".join(rng.choices(["Ka", "kolo", "12", "brim", "été"], k=k)) for k in (4, 0, 30, 1, 0, 9)])
    wanted = L.words_of(texts)
    lexicon = np.sort(L.hashes_of(wanted[1])[:3])
    features = L.word_features(wanted[1], lexicon)
    for size in (1, 40, 1 << 20):
        monkeypatch.setattr(L, "CUT_CHARS", size)
        monkeypatch.setattr(L, "WORDS", size)
        codes, words, offsets = L.training_words(texts)
        assert (codes.tolist(), words.to_pylist(), offsets.tolist()) == (wanted[0].tolist(), wanted[1].to_pylist(), wanted[2].tolist())
        assert all(np.array_equal(a, b) for a, b in zip(L.features_of(words, lexicon), features))
    assert [len(x) for x in L.training_words(pa.array([], pa.string()))] == [0, 0, 1] and len(L.training_words(pa.array(["", " "]))[0]) == 0


def test_memory_of_fitting_languages():
    rng = random.Random(11)
    texts = pa.array([" ".join("".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(200)) for _ in range(300)])
    assert _peak_mb(lambda: L.fit(texts, ["xx", "yy"] * 150, sequences=600, rounds=1)) < 50


def test_languages(spark, empty):
    rng = random.Random(4)
    vocabulary = {"xx": ["ka", "kolo", "kaki", "oklo"], "yy": ["bre", "brim", "imbre", "remb"]}
    rows = [(i, " ".join(rng.choices(vocabulary[lang], k=rng.randint(3, 90))), lang) for i, lang in enumerate(["xx", "yy"] * 40)]
    rows += [(1000, None, "xx"), (1001, "", "yy"), (1002, "123 !!", "xx"), (1003, "Kolo KAKI zzz", None), (None, "brim bre", None),
             (1004, " ".join(["kolo"] * 50 + ["brim"] * 20), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    field = L.train(docs, crc_remainder("doc_id", 4) != 2)
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs, field).collect()}
    assert all(got[k][0] == lang for k, _, lang in rows[:80])
    assert [got[k] for k in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003][0] == "xx" and got[None][0] == "yy"
    assert got[1004][0] == "xx" and 0.6 < got[1004][1] < 0.85  # words of both languages are told apart
    assert L.predict(empty, field).count() == 0
    assert L.predict(docs, L.train(empty, F.lit(True))).where("lang_pred <> 'und'").count() == 0


# --- packing -----------------------------------------------------------------

def _check_plan(counts, capacity):
    plan = P.pack_lengths(counts, capacity)
    assert plan.used == {s: n for s, n in counts.items() if n}
    places = sorted(plan.places)
    filled = collections.defaultdict(list)
    for i, (s, rank, first, per, offset) in enumerate(places):
        last = places[i + 1][1] if i + 1 < len(places) and places[i + 1][0] == s else counts[s]
        for r in range(last - rank):
            filled[first + r // per].append((offset + r % per * s, s))
    for seq in filled.values():
        at = 0
        for offset, s in sorted(seq):
            assert offset == at
            at += s
        assert at <= capacity
    assert len(filled) == plan.sequences
    return plan.sequences


def _fewest(items, capacity):
    """The least number of bins, by search."""
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in set(bins):
            if room >= items[i]:
                j = bins.index(room)
                go(i + 1, bins[:j] + [room - items[i]] + bins[j + 1:])
        go(i + 1, bins + [capacity - items[i]])

    go(0, [])
    return best[0]


def test_plans():
    rng = random.Random(6)
    over = 0
    for _ in range(150):
        items = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 10))), reverse=True)
        got, least = _check_plan(dict(collections.Counter(items)), 20), _fewest(items, 20)
        over += got - least
        assert least <= got <= least + 1
    assert over <= 3
    assert _check_plan({}, 20) == 0
    for _ in range(20):
        counts = {s: rng.randint(0, 400) for s in rng.sample(range(1, 101), 30)}
        total = sum(s * n for s, n in counts.items())
        assert _check_plan({s: n for s, n in counts.items() if n}, 100) <= total / 100 * 1.05 + sum(n for s, n in counts.items() if s > 50)


def test_dominance_never_costs():
    """What the reduction fixes can be part of a best packing."""
    rng = random.Random(8)
    for _ in range(120):
        items = sorted((rng.randint(3, 20) for _ in range(rng.randint(2, 9))), reverse=True)
        counts = np.zeros(21, np.int64)
        for s in items:
            counts[s] += 1
        plan = P.Plan(20)
        P.reduce_by_dominance(counts, plan)
        rest = [s for s in range(20, 0, -1) for _ in range(int(counts[s]))]
        assert plan.sequences + _fewest(rest, 20) == _fewest(items, 20)


def test_packed_documents(spark, odd, empty):
    from tokenizers import Tokenizer
    path = tokenizer_file("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    got = P.pack(odd, path, 64).collect()
    want = collections.Counter()
    for r in odd.collect():
        ids = np.array(t.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        for i, a in enumerate(range(0, len(ids), 64)):
            want[r.doc_id, i, a, len(ids[a:a + 64]), ids[a:a + 64].tobytes()] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in got) == want
    filled = collections.defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for seq in filled.values():
        at = 0
        for offset, n in sorted(seq):
            assert offset == at
            at += n
        assert at <= 64
    assert P.pack(empty, path, 64).count() == 0


# --- sentencepiece -------------------------------------------------------------

def test_pieces(spark, odd, empty):
    path = tokenizer_file("piece_bpe_32k.model")
    c = codec(path)
    got = collections.Counter((r.doc_id, tuple(r.ids), r.decoded) for r in encode_decode(odd, path).collect())
    want = collections.Counter()
    for r in odd.collect():
        ids = c.library.encode(r.text or "")
        want[r.doc_id, tuple(ids), c.library.decode(ids)] += 1
    assert got == want
    assert encode_decode(empty, path).count() == 0
    rng = random.Random(9)
    letters = "ab  \n\t▁éß日😀.,-0x<>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    ids, offsets = c.encode_texts(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == c.library.encode(texts)


# --- line dedup ----------------------------------------------------------------

def test_lines(spark, odd, empty):
    rng = random.Random(10)
    pool = [f"line {i}" for i in range(12)] + ["", "  "]
    rows = [(i, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\r"]) for _ in range(rng.randint(0, 14)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a\na\na\na\na"), (103, "a\nb\nc"), (104, "a\nb\nc"), (105, "z\na\nb\nc\n\nnew")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("removed_lines", F.lit("clash")).withColumn("h1", F.lit(1))
    got = {r.doc_id: (r.text, r.removed_lines) for r in dedup_lines(docs).collect()}
    assert got == brute.dedup_lines(rows)
    assert got[104] == ("", [0, 1, 2]) and got[105] == ("z\n\nnew", [1, 2, 3])
    twice = spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in dedup_lines(twice).collect()) == [(0, "a\nb\nc"), (1, ""), (1, "")]
    assert dedup_lines(odd).count() == odd.count() and dedup_lines(empty).count() == 0


# --- n-gram join -----------------------------------------------------------------

def _family(rng, vocabulary, size):
    base = [rng.choice(vocabulary) for _ in range(size)]
    for _ in range(rng.choice([1, 2, 6])):
        w = list(base)
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            i = rng.randrange(len(w))
            if rng.random() < 0.6:
                w[i] = rng.choice(vocabulary)
            elif len(w) > 1:
                del w[i]
        yield " ".join(w)


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_components(spark, n, percent):
    rng = random.Random(n)
    vocabulary = [f"w{i}" for i in range(2500)]
    texts = [t for _ in range(35) for t in _family(rng, vocabulary, rng.choice([2, 4, 7, 11, 25, 60, 120, 400]))] + ODD_TEXTS
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash")).withColumn("key", F.lit(0))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(docs, n, percent).collect()}
    assert got == brute.components(rows, n, percent)


def test_components_of_odd_rows(spark, empty):
    rows = [(5, "a b c d"), (5, "a b c d"), (3, "A B C D"), (None, "a b c d"), (9, None), (8, ""), (7, "  ")]
    got = J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter([(5, 2, 3), (5, 2, 3), (3, 2, 3), (None, 2, None), (9, 0, 9), (8, 0, 8), (7, 0, 7)])
    assert J.jaccard_components(empty, 3, 90).count() == 0


def test_schemes_cover_all_links():
    """Any two sets that link share a key that one of them has for a whole segment."""
    rng = np.random.default_rng(12)
    for percent in (50, 80, 90):
        for _ in range(300):
            n = int(rng.integers(1, 60))
            a = rng.integers(0, 1 << 62, n).astype(np.uint64)
            b = np.concatenate([a[rng.random(n) > rng.choice([0.0, 0.05, 0.15])], rng.integers(0, 1 << 62, int(rng.integers(0, max(2, n // 4)))).astype(np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if len(b) and 0 < 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
                (ka, ca), (kb, cb) = J.index_keys(a, percent), J.index_keys(b, percent)
                assert len(np.intersect1d(ka, np.concatenate([kb, cb]))) or len(np.intersect1d(kb, ca))
                x, y = J._folded([J.parity_bitmap(a), J.parity_bitmap(b)])
                assert np.bitwise_count(x ^ y).sum() <= len(a) + len(b) - 2 * both


def test_line_dedup_keeps_columns_of_any_name(spark):
    text = "one line\ntwo line\nthree line\nown"
    rows = [(i, text + str(i), "k", i * 2, "x", "y", [9]) for i in (1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __covered string, __id long, hash string, row string, removed_lines array<int>")
    got = sorted(dedup_lines(df).collect())
    assert [tuple(r) for r in got] == [(1, text + "1", "k", 2, "x", "y", []), (2, "own2", "k", 4, "x", "y", [0, 1, 2])]
