"""Periodic runs of words: against a plain version, and on odd tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from filingflow.llm import word_runs as R
from filingflow.llm.queries import QUERIES


def plain_runs(words, least=6, exponent=4):
    """Every maximal stretch of every period, by comparing words q apart."""
    n, out = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q) and j > i:
                stretch = words[i:j + q]
                if not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                    out.add((i, j + q - i, q))
            i = j + 1 if j > i else i + 1
    runs = sorted(out, key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_loop(words, seed):
    n = len(words)
    if seed is None or seed < 0 or seed % 10 or not n:
        return words
    g = seed // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _text(rnd):
    n, k = rnd.choice([0, 1, 5, 6, 7, 8, 20, 100, 400]), rnd.choice([1, 2, 3, 50])
    words = [rnd.choice("abcdefghijklmnopqrstuvwxyz"[:k]) * rnd.randint(1, 1 + k // 20) for _ in range(n)]
    if n and rnd.random() < 0.4:
        words = words[:n // 5] + words[:rnd.randint(1, max(1, n // 3))] * rnd.randint(2, 9) + words[n // 5:]
    return "".join(w + rnd.choice([" ", "\n", "\t\r ", "\x0b"]) for w in words)


@pytest.mark.parametrize("points", [2 << 20, 64])
@pytest.mark.parametrize("exponent,least", [(4, 6), (2, 1), (3, 10)])
def test_runs_against_plain(monkeypatch, points, exponent, least):
    monkeypatch.setattr(R, "POINTS", points)
    rnd = random.Random(points + exponent)
    for _ in range(12):
        texts = [_text(rnd) for _ in range(rnd.randint(1, 25))]
        seeds = [rnd.choice([-1, rnd.randint(0, 10 ** 6), 10 * rnd.randint(0, 10 ** 5)]) for _ in texts]
        runs, collapsed = R.block_runs(pa.array(texts, pa.string()), np.array(seeds), least, exponent)
        for text, seed, r, c in zip(texts, seeds, runs.to_pylist(), collapsed.to_pylist()):
            assert ([(x["start"], x["length"], x["period"]) for x in r], c) == plain_runs(plain_loop(text.split(), seed), least, exponent)


def test_lce_against_plain():
    rnd = random.Random(3)
    segments = [[rnd.randint(1, 2) for _ in range(n)] for n in (1, 31, 200, 90)] + [[1] * 150, [1, 2, 3] * 60]
    words, starts = [], []
    for s in segments:
        starts.append(len(words))
        words += s + [0]
    lce = R.CoverLCE(np.array(words), np.array(starts), np.array([len(s) for s in segments]))
    pairs = [(b + i, b + j) for b, s in zip(starts, segments) for i in range(len(s)) for j in range(i + 1, len(s))]
    i, j = (np.array(x) for x in zip(*pairs))
    want = []
    for x, y in pairs:
        k = 0
        while words[x + k] == words[y + k] and words[x + k]:
            k += 1
        want.append(k)
    assert lce.lce(i, j).tolist() == want


def test_long_loop_is_one_run():
    words = [f"w{i}" for i in range(2000)] * 9
    runs, collapsed = R.block_runs(pa.array(["x " + " ".join(words) + " y"]), np.array([-1]), 6, 4)
    assert runs.to_pylist() == [[{"start": 1, "length": 18000, "period": 2000}]]
    assert collapsed.to_pylist() == ["x " + " ".join(words[:2000]) + " y"]


def test_odd_table(spark):
    rows = [(None, "a a a a a a", "c"), (1, None, "c"), (2, "", "c"), (3, " \t\n", "c"), (4, "a b a b a b a b", None), (4, "a b a b a b a b", None),
            (5, "A a A a A a A a", "c"), (6, "a a a a " * 5, "c")]
    schema = "doc_id long, text string, runs string"
    got = sorted([(r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in R.word_runs(spark.createDataFrame(rows, schema)).collect()])
    assert got == sorted([(i or 0, *plain_runs([w for w in re.split("[ \t-\r]+", t or "") if w]))
                          for i, t, _ in rows])
    assert R.word_runs(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(ValueError):
        R.word_runs(spark.createDataFrame(rows, schema), exponent=1)


def test_query_against_plain(spark):
    path = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op11_word_runs"](spark, path).collect()}
    table = pq.read_table(f"{path}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(got) == len(table)
    for row in table:
        words = [w for w in re.split("[ \t-\r]+", row["text"] or "") if w]
        if len(words) > 3000:  # the plain version is quadratic
            continue
        runs, collapsed = plain_runs(plain_loop(words, zlib.crc32(str(row["doc_id"]).encode())))
        r = got[row["doc_id"]]
        best = min(((-length, s, q) for s, length, q in runs), default=None)
        want = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        assert (r.n_runs, r.start, r["length"], r.period, r.exponent_milli) == (len(runs), want[0], want[1], want[2], want[3])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed.encode()).hexdigest()
