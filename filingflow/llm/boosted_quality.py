"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text (character classes, word and line repetition, sizes) are
computed for whole blocks of texts with numpy; there is no per-document Python
loop. Trees are grown level by level on histograms of binned statistics with
logistic loss, and kept as complete binary trees in flat arrays, so that a
block of texts walks down all trees at once. Training sees a bounded sample of
labelled documents (``train_rows``); every document is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, interned, one_array, prepare, texts_of, words_of

#: byte classes that are counted
CLASSES = {"lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t", "line": b"\n",
           "stop": b".", "comma": b",;:", "mark": b"!?", "bar": b"|", "odd": b"#$%&*+=<>@\\^_`{}~/", "quote": b"\"'()[]-"}
STATISTICS = [*(f"share_{c}" for c in CLASSES), "share_other", "log_bytes", "log_words", "word_bytes", "longest_word", "short_words", "marked_words",
              "distinct_words", "top_word", "same_word", "distinct_pairs", "log_lines", "line_words", "distinct_lines", "no_letter_words"]


def _classes() -> np.ndarray:
    out = np.full(256, len(CLASSES), np.uint8)
    for k, members in enumerate(CLASSES.values()):
        out[np.frombuffer(members, np.uint8)] = k
    return out


def _spans_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _distinct(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: how many distinct codes, and how often the most frequent one occurs."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    cells, times = np.unique((row << 40) + codes, return_counts=True)
    owner = cells >> 40
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, times)
    return np.bincount(owner, minlength=n), top


def statistics(texts: pa.Array) -> np.ndarray:
    """The statistics of each text, one row each; an empty text has zeros."""
    n = len(texts)
    raw = texts.cast(pa.binary())
    at = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[at[0]:at[-1]] if n else np.empty(0, np.uint8)
    at = at - (at[0] if n else 0)
    size = np.diff(at)
    kind = _classes()[data]
    shares = [_spans_sum(kind == k, at) / np.maximum(size, 1) for k in range(len(CLASSES) + 1)]

    codes, words, offsets = words_of(texts, lower=False)
    count = np.diff(offsets)
    some = np.maximum(count, 1)
    length = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    letters = pc.match_substring_regex(words, r"\pL").to_numpy(zero_copy_only=False)
    marked = pc.match_substring_regex(words, r"[^\pL\pN.,;:'\"()?-]$").to_numpy(zero_copy_only=False)
    long_ = np.zeros(n, np.int64)
    np.maximum.at(long_, np.repeat(np.arange(n), count), length[codes])
    distinct, top = _distinct(codes, offsets)
    same = np.zeros(len(codes), bool)
    same[1:] = codes[1:] == codes[:-1]
    same[offsets[:-1][count > 0]] = False
    pairs = codes.copy()
    pairs[1:] += codes[:-1] << 20 if len(words) < 1 << 20 else codes[:-1] * len(words) % (1 << 39)
    pair_kinds, _ = _distinct(pairs, offsets)

    line_codes, _, line_at = interned(pc.split_pattern(texts, "\n"))
    lines = np.diff(line_at)
    line_kinds, _ = _distinct(line_codes, line_at)
    columns = [*shares, np.log1p(size), np.log1p(count), _spans_sum(length[codes], offsets) / some, long_, _spans_sum(length[codes] <= 3, offsets) / some,
               _spans_sum(marked[codes], offsets) / some, distinct / np.sqrt(some), top / some, _spans_sum(same, offsets) / some, pair_kinds / some,
               np.log1p(lines), count / np.maximum(lines, 1), line_kinds / np.maximum(lines, 1), _spans_sum(~letters[codes], offsets) / some]
    return np.column_stack(columns).astype(np.float32)


class BoostedTrees:
    """Trees as flat arrays: node i of a tree has children 2i+1 and 2i+2."""

    def __init__(self, depth: int, prior: float):
        self.depth, self.prior = depth, prior
        self.feature = np.zeros((0, (1 << depth) - 1), np.int32)
        self.threshold = np.zeros((0, (1 << depth) - 1), np.float32)
        self.leaf = np.zeros((0, 1 << depth), np.float64)

    def margins(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))
        out = np.full(len(x), self.prior)
        if not len(trees):
            return out
        for a in range(0, len(x), 4096):
            part = x[a:a + 4096]
            rows = np.arange(len(part))[:, None]
            node = np.zeros((len(part), len(trees)), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (part[rows, self.feature[trees, node]] > self.threshold[trees, node])
            out[a:a + 4096] += self.leaf[trees, node - ((1 << self.depth) - 1)].sum(axis=1)
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 1.0, least_rows: int = 10) -> BoostedTrees:
    """Boosted trees for labels 0 and 1. Classes weigh alike, so that a rare
    label isn't outvoted; a sample of one class (or none) gives its prior."""
    ones = float(y.sum())
    if not len(y) or ones == 0 or ones == len(y):
        return BoostedTrees(depth, 0.0 if not len(y) else 4.0 if ones else -4.0)
    weight = np.where(y == 1, len(y) / (2 * ones), len(y) / (2 * (len(y) - ones)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])  # bin b: at most edge b
    n, m = binned.shape
    model = BoostedTrees(depth, 0.0)
    margin = np.zeros(n)
    cells = binned + np.arange(m) * bins
    inner, leaves = (1 << depth) - 1, 1 << depth
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int32), np.full(inner, np.inf, np.float32)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width = 1 << level
            local = node - (width - 1)
            key = (local[:, None] * (m * bins) + cells).ravel()
            shape = (width, m, bins)
            sums = [np.bincount(key, weights=np.repeat(v, m), minlength=width * m * bins).reshape(shape) for v in (g, h, np.ones(n))]
            left = [np.cumsum(s, axis=2)[:, :, :-1] for s in sums]
            total = [s.sum(axis=2, keepdims=True) for s in sums]
            right = [t - a for t, a in zip(total, left)]
            gain = left[0] ** 2 / (left[1] + l2) + right[0] ** 2 / (right[1] + l2) - total[0] ** 2 / (total[1] + l2)
            gain[(left[2] < least_rows) | (right[2] < least_rows)] = -1
            best = gain.reshape(width, -1).argmax(axis=1)
            worth = gain.reshape(width, -1).max(axis=1) > 1e-9
            f, b = best // (bins - 1), best % (bins - 1)
            at = np.arange(width - 1, 2 * width - 1)
            feature[at] = np.where(worth, f, 0)
            threshold[at] = [edges[i][min(j, len(edges[i]) - 1)] if ok and len(edges[i]) else np.inf for i, j, ok in zip(f, b, worth)]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, weights=g, minlength=leaves) / (np.bincount(leaf, weights=h, minlength=leaves) + l2)
        margin += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    model.feature, model.threshold, model.leaf = np.array(features), np.array(thresholds), np.array(values)
    return model


def train(docs: DataFrame, labels: DataFrame, learn: Column, train_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> BoostedTrees:
    """Trees from at most ``train_rows`` labelled documents: those that come
    first by a hash of the id. ``learn`` says, over ``id_col``, which labels
    may be used. Null labels and ids are left out; of several labels of an id
    the mean counts, of several texts the one with the smallest hash."""
    chosen = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & learn)
              .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # a side of at most train_rows narrow rows is broadcast
    rows = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", F.xxhash64("text").alias("h"), "text", "label")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 4 << 20):
            x = statistics(texts_of(block, "text"))
            yield pa.RecordBatch.from_arrays([*[one_array(block.column(c)) for c in ("doc_id", "h", "label")], pa.array(x.tolist(), pa.list_(pa.float32()))],
                                             names=["doc_id", "h", "label", "x"])

    # one row per chosen id, however often it is repeated
    each = rows.mapInArrow(run, f"doc_id {kind}, h long, label int, x array<float>")
    got = each.groupBy("doc_id").agg(F.min(F.struct("h", "x", "label")).alias("r")).select("r.label", "r.x").toArrow()
    if not got.num_rows:
        return fit(np.zeros((0, len(STATISTICS))), np.zeros(0))
    x = one_array(got.column("x")).flatten().to_numpy().reshape(-1, len(STATISTICS))
    y = one_array(got.column("label")).to_numpy()
    order = np.lexsort((*x.T, y))  # rows arrive in any order; the trees are the same
    return fit(x[order], y[order].astype(float))


def score(docs: DataFrame, model: BoostedTrees, id_col: str = "doc_id", text_col: str = "text", out: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` and the column ``out``: how likely a
    text is of label 1, 0 to 1. Null and empty texts have the statistics of an
    empty text; repeated rows get the same score; an empty table gives an
    empty result. A column named as ``out`` is replaced."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    docs = docs.drop(out)
    shape = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col, 4 << 20):
            s = shared.value.scores(statistics(texts_of(block, text_col)))
            yield from block.append_column(out, pa.array(s)).to_batches()

    return docs.mapInArrow(run, shape)
