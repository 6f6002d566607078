"""Whitening against an eigendecomposition, resharding against its laws and a
plain optimum, and both on odd tables."""

import collections
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from filingflow.llm import resharding as S
from filingflow.llm import whitening as W
from filingflow.llm.queries import QUERIES
from filingflow.session import new_run_dir

VECTORS = "vec_id long, embedding array<double>, n string"


def _plain(x):
    n = len(x)
    e, v = np.linalg.eigh(np.cov(x.T.astype(float), bias=True))
    return n, x.sum(axis=0), e[::-1], v[:, ::-1]


def test_whitening_query(spark):
    table = [(r["vec_id"], r["embedding"]) for r in pq.read_table("/root/testdata/sf0.01/embeddings.parquet").to_pylist()]
    rows = sorted((i, v) for i, v in table if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v))
    x = np.floor(1024 * np.array([v for _, v in rows], float)).astype(np.int64) + 100_000
    n, sums, e, v = _plain(x)
    want = (x - sums / n) @ v[:, :8] / np.sqrt(e[:8])
    got = QUERIES["op12_cholesky_whitening"](spark, "/root/testdata/sf0.01").toPandas().sort_values(["vec_id", "component"])
    assert got.vec_id.tolist() == [i for i, _ in rows for _ in range(8)] and set(got.n) == {n}
    y = got.whitened.to_numpy().reshape(n, 8)
    assert np.abs(y * np.sign((y * want).sum(axis=0)) - want).max() < 1e-8
    assert got.deviation.tolist()[::8] == [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x]
    assert np.allclose(got.explained.to_numpy()[:8], e[:8] / e.sum(), rtol=1e-9) and got.identity_error.max() < 1e-9


@pytest.mark.parametrize("spread", [1.0, 1e-7, 0.0])
def test_ill_conditioned_and_singular(spark, spread):
    """Two directions carry next to nothing, or nothing at all."""
    rnd = np.random.default_rng(1)
    a = rnd.normal(size=(400, 4)) * [1e6, 10.0, spread, spread] @ np.linalg.qr(rnd.normal(size=(4, 4)))[0]
    if spread == 0.0:
        a[:, 3] = a[:, 2]
    x = np.floor(1024 * a).astype(np.int64) + 100_000
    rows = spark.createDataFrame([(i, r.tolist(), "z") for i, r in enumerate(a)], VECTORS)
    got = W.whiten(rows).collect()
    n, sums, e, v = _plain(x)
    rank = np.linalg.matrix_rank(x - sums / n)
    assert {len(r.whitened) for r in got} == {rank}
    y = np.array([r.whitened for r in sorted(got, key=lambda r: r.vec_id)])
    assert np.abs(y.T @ y / n - np.eye(rank)).max() < 1e-6 and max(r.identity_error for r in got) < 1e-6


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.5], "a"), (1, [0.5, 1.5], "a"), (None, [2.5, -1.0], None), (2, [3.0, 4.25], "a"), (3, None, "a"), (4, [], "a"), (5, [None, 1.0], "a"),
            (6, [nan, 1.0], "a"), (7, [inf, 1.0], "a"), (8, [1.0, 2.0, 3.0], "a"), (9, [1e300, 0.0], "a"), (10, [0.0, 0.0], "a")]
    got = W.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert collections.Counter(r.vec_id for r in got) == {1: 2, None: 1, 2: 1, 10: 1}
    assert {r.n for r in got} == {5} and all(len(r.whitened) == 2 for r in got)
    assert W.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    same = W.whiten(spark.createDataFrame([(1, [1.0, 2.0], "a"), (2, [1.0, 2.0], "a")], VECTORS)).collect()
    assert [(r.n, r.deviation, r.whitened) for r in same] == [(2, 0, []), (2, 0, [])]


def test_deviation_beyond_a_long():
    x = np.array([[2 ** 31, 0], [0, 2 ** 31], [5, 7]], np.int64)
    n, sums = 3, x.sum(axis=0)
    want = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x]
    assert W.deviations(x, n, sums).to_pylist() == [w if w < 2 ** 63 else None for w in want] and None in W.deviations(x, n, sums).to_pylist()


# --- resharding ---------------------------------------------------------------

def test_transfers_move_the_least():
    rnd = random.Random(2)
    for _ in range(200):
        n, m = rnd.randint(1, 7), rnd.randint(1, 7)
        old = [rnd.randint(0, 50) for _ in range(n)]
        new = [rnd.randint(0, 50) for _ in range(m)]
        if sum(new) < sum(old):
            new[-1] += sum(old) - sum(new)
        goes = S.transfers(old, new)
        for i in range(n):
            assert sum(b for (a, _), b in goes.items() if a == i) == old[i]
        for j in range(m):
            assert sum(b for (_, a), b in goes.items() if a == j) <= new[j]
        # staying is free and all moves cost the same, so the optimum is what can't stay
        assert sum(b for (i, j), b in goes.items() if i != j) == sum(max(0, s - (new[i] if i < m else 0)) for i, s in enumerate(old))
    with pytest.raises(ValueError):
        S.transfers([5, 5], [4, 5])


def test_flow_with_costs():
    net = S.FlowNetwork()
    for a, b, room, cost in ((0, 1, 4, 1), (0, 2, 5, 2), (1, 2, 3, -1), (1, 3, 2, 6), (2, 3, 6, 1)):
        net.arc(a, b, room, cost)
    # into 3 go 2 + 6; of the 4 on arc 0-1 two go straight on and two by arc 1-2, so arc 0-2 has 4
    assert net.solve(0, 3) == (8, 4 * 1 + 4 * 2 - 2 * 1 + 2 * 6 + 6 * 1)


def test_capacities():
    assert S.capacities([0, 0, 0], 7) == [3, 2, 2]
    assert S.capacities([10, 0, 4], 6) == [0, 5, 1]
    assert S.capacities([5, 5], 0) == [0, 0]


def _laws(spark, table, got, shards):
    want = collections.Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in table)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(0 <= s < shards and sorted(x) == list(range(len(x))) for s, x in slots.items())
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(shards)]
    assert max(sizes) - min(sizes) <= max(r.size for r in got) + 1
    return sizes


def test_resharding_query(spark):
    table = [(r["doc_id"], r["text"]) for r in pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()]
    got = QUERIES["op13_flow_resharding"](spark, "/root/testdata/sf0.01").collect()
    sizes = _laws(spark, table, got, 24)
    assert max(sizes) < 1.01 * sum(sizes) / 24 and {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    text = dict(table)
    homes = collections.defaultdict(set)
    for r in got:
        homes[text[r.doc_id]].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def _run(spark, rows, shards, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, unit string")
    text = F.col("row.text")
    return S.reshard(docs, shards, columns={"doc_id": F.col("row.doc_id"), "size": S.size_of(text),
                                            "text_crc32": F.crc32(F.coalesce(text, F.lit("")).cast("binary"))}, **kw).collect()


def test_hot_text_and_odd_rows(spark):
    rnd = random.Random(4)
    rows = [(i, "hot copy of a text", 7, "x") for i in range(700)]
    rows += [(1000 + i, "".join(rnd.choice("abcdé ") for _ in range(rnd.randint(0, 200))), 7, "x") for i in range(700)]
    rows += [(None, None, None, None), (5, None, 1, "x"), (5, None, 1, "x"), (6, "", 1, "x"), (None, "a", 1, "y")]
    got = _run(spark, rows, 24)
    sizes = _laws(spark, [(r[0], r[1]) for r in rows], got, 24)
    assert max(sizes) < 1.02 * sum(sizes) / 24
    assert len({r.shard for r in got if r.text_crc32 == zlib.crc32(b"hot copy of a text")}) > 1
    assert _run(spark, [], 24) == []
    assert len({r.shard for r in _run(spark, [(1, "long" * 5000, 1, "x"), (2, "b", 1, "x"), (3, "c", 1, "x")], 2)}) == 2


def test_only_affected_files_are_rewritten(spark, monkeypatch):
    monkeypatch.setattr(S, "UNITS", 96)  # so that units hold several rows here too
    root = new_run_dir(spark, "reshard-test")
    rnd = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join(rnd.choices("lorem ipsum dolor sit amet".split(), k=40)) + str(i), "kept") for i in range(3000)],
                                 "doc_id long, text string, size string")
    before = S.lay_out(docs, root, 6)
    old = {u.unit: u.shard for u in before}
    units = S.plan(before, 6, 8)
    S.rewrite(spark, root, units)
    stayed = {u.unit for u in units if u.target == u.shard}
    moved_bytes = sum(u.bytes for u in units if u.unit not in stayed)
    total = sum(u.bytes for u in units)
    assert moved_bytes < 0.3 * total  # two new shards of eight take a quarter
    assert {r.unit for r in spark.read.parquet(f"{root}/v1").select("unit").distinct().collect()} < set(old)
    files = {(r.shard, r.file) for r in spark.read.parquet(f"{root}/v0").select("shard", "file").distinct().collect()}
    touched = {(u.shard, u.file) for u in units if u.unit not in stayed}
    assert touched < files and len(touched) < 0.7 * len(files)
    back = S.read_shards(spark, root)
    assert back.select("row.*").exceptAll(docs).count() == 0 and back.count() == 3000
    where = {u.unit: u.target for u in units}
    assert all(where[r.unit] == r.shard for r in back.select("unit", "shard").distinct().collect())
    # nothing to move: all files stay where they are
    again = new_run_dir(spark, "reshard-test")
    units = S.lay_out(docs, again, 6)
    for u in units:
        u.target, u.start = u.shard, 0
    S.rewrite(spark, again, units)
    assert S.read_shards(spark, again).count() == 3000
