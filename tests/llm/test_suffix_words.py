"""The suffix tree's symbols are words, not the classes that smooth them: against a plain tree."""

import collections
import math
import os
import random
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from filingflow.llm import suffix_tree as S  # noqa: E402

END, START = ("end",), ("start",)


def scored(spark, rows, **given):
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
    got = S.score_documents(docs, F.col("held"), **given).collect()
    assert len(got) == len(rows)
    return {r.doc_id: r.score for r in got}


def of_class(w):
    return 0 if w in (END, START) else int(S.word_classes(pa.array([w]))[0])


def plain(rows, depth, least_count, divergence):
    """{id: score} by a tree over words in dictionaries."""
    texts = {k: [START, *brute.words(t), END] for k, t, _ in rows}
    train = [texts[k] for k, _, held in rows if not held]
    count = collections.Counter(w for t in train for w in t[1:])
    in_class = collections.defaultdict(collections.Counter)
    for w, n in count.items():
        in_class[of_class(w)][w] = n
    zero, pairs = collections.Counter(), collections.defaultdict(collections.Counter)
    for t in train:
        for a, b in zip(t, t[1:]):
            zero[of_class(b)] += 1
            pairs[of_class(a)][of_class(b)] += 1

    def class_one(b):
        n, kinds = sum(zero.values()), len(zero)
        return (zero[b] + kinds / S.SYMBOLS) / (n + kinds) if n else 1 / S.SYMBOLS

    class_states = set()
    for a, after in pairs.items():
        n, kinds = sum(after.values()), len(after)
        gain = sum(c * math.log((c + kinds * class_one(b)) / (n + kinds) / class_one(b)) for b, c in after.items())
        if n >= least_count and gain >= divergence * kinds:
            class_states.add(a)

    def lowest(before, w):
        a, b = of_class(before), of_class(w)
        p = class_one(b)
        if depth and a in class_states:
            n, kinds = sum(pairs[a].values()), len(pairs[a])
            p = (pairs[a][b] + kinds * p) / (n + kinds)
        own = in_class[b]
        return p if w == END else p * (own[w] + 0.1) / (sum(own.values()) + 0.1 * (len(own) + 1))

    after = collections.defaultdict(collections.Counter)
    for t in train:
        for i in range(1, len(t)):
            for k in range(1, min(depth, i) + 1):
                after[tuple(t[i - k:i])][t[i]] += 1
    states = {}

    def p(context, w):
        if not context[1:]:
            below = lowest(context[-1], w)
        else:
            below = p(context[1:], w)
        if not states.get(context):
            return below
        own = after[context]
        n, kinds = sum(own.values()), len(own)
        return (own[w] + kinds * below) / (n + kinds)

    for context in sorted(after, key=len):
        own = after[context]
        n, kinds = sum(own.values()), len(own)
        below = {w: (p(context[1:], w) if context[1:] else lowest(context[-1], w)) for w in own}
        gain = sum(c * math.log((c + kinds * below[w]) / (n + kinds) / below[w]) for w, c in own.items())
        states[context] = n >= least_count and gain >= divergence * kinds
    out = {}
    for k, t in texts.items():
        out[k] = sum(math.log10(p(tuple(t[max(0, i - depth):i]), t[i]) if depth else lowest(t[i - 1], t[i])) for i in range(1, len(t)))
    return out, collections.Counter(len(c) for c, yes in states.items() if yes)


def corpus(seed, texts):
    rnd = random.Random(seed)
    words = [a + b + "ed" for a in ("t", "qu", "zor", "mi") for b in ("a", "el", "opp")] + ["is", "on", "x"]
    phrases = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(2, 7))) for _ in range(12)]
    rows = [(i, " ".join(rnd.choice(phrases if rnd.random() < 0.7 else words) for _ in range(rnd.randrange(0, 9))), i % 5 == 0) for i in range(texts)]
    return rows + [(texts, None, False), (texts + 1, "", True), (texts + 2, "never seen words here", True)]


def test_words_of_one_class_are_told_apart(spark):
    """op2: contexts were runs of classes, so words of one class decided the next word alike."""
    a, b, p, q = "walked", "jumped", "slowly", "highly"
    classes = S.word_classes(pa.array([a, b, p, q]))
    assert classes[0] == classes[1] and classes[2] == classes[3]
    rows = [(i, f"{a} {p}" if i % 2 else f"{b} {q}", False) for i in range(20)] + [(100, f"{a} {p}", True), (101, f"{a} {q}", True)]
    got = scored(spark, rows)
    assert got[100] - got[101] > 0.5


@pytest.mark.parametrize("hot", [None, 16])
def test_scores_are_those_of_a_tree_over_words(spark, monkeypatch, hot):
    """With small buckets, and contexts of over 16 occurrences dealt over several; with one part, and several."""
    rows = corpus(7, 120)
    monkeypatch.setattr(S, "BUCKET_BYTES", 400 if hot else 3000)
    if hot:
        monkeypatch.setattr(S, "HOT", hot)
    want, states = plain(rows, 4, 4, 0.3)
    assert all(states[k] for k in (1, 2, 3, 4))
    got = scored(spark, rows, divergence=0.3)
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k] - want[k]) < 1e-4 * max(1, -want[k]), k


def test_shorter_depths_and_no_training(spark):
    rows = corpus(8, 25)
    for depth in (0, 1):
        want, _ = plain(rows, depth, 4, 1.0)
        got = scored(spark, rows, depth=depth)
        assert all(abs(got[k] - want[k]) < 1e-4 * max(1, -want[k]) for k in want)
    nothing = [(k, t, True) for k, t, _ in rows]
    want, _ = plain(nothing, 4, 4, 1.0)
    got = scored(spark, nothing)
    assert all(abs(got[k] - want[k]) < 1e-4 * max(1, -want[k]) for k in want)
