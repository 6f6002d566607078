"""Language identification with a linear-chain conditional random field.

Each word of a text gets a label (a language); a text may switch between
languages. A word's features are its character n-grams with boundary marks
(so prefixes and suffixes among them), hashed, and the word itself if it is in
the lexicon of frequent training words. Neighbouring labels are tied by
learned transition weights. Training maximises the likelihood of label
sequences made of runs of words from documents of one language or several, so
that transitions between languages are learnt as well as staying.

Marginals come from forward-backward. Texts are cut into segments whose
transfer matrices are multiplied up first, so that all segments of a block
advance together and the result is that of one pass over each whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.sql import types as T

from .common import blocks, give_back, hashes_of, mix64, one_array, prepare, texts_of, words_of

UNKNOWN = "und"
BUCKETS = 1 << 16
NGRAMS = (1, 2, 3, 4)
LEXICON = 8000
SEGMENT = 64
#: text bytes of documents that a worker predicts at once
PREDICT_BLOCK_BYTES = 2 << 20
#: distinct words whose features are listed at once, places of words times
#: labels whose marginals are, and characters of training texts cut into words
WORDS, CELLS, CUT_CHARS = 1 << 12, 1 << 19, 1 << 20
_OPEN, _CLOSE = 2, 3


def word_features(words: pa.Array, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of distinct lower-cased words: (features, offsets)."""
    raw = words.cast(pa.binary())
    n = len(raw)
    if not n:
        return np.empty(0, np.int64), np.zeros(1, np.int64)
    at = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw.buffers()[2], np.uint8)[at[0]:at[-1]]
    size = np.diff(at)
    ends = np.cumsum(size + 2)
    starts = ends - size - 2
    flat = np.empty(int(ends[-1]), np.uint64)
    flat[starts], flat[ends - 1] = _OPEN, _CLOSE
    flat[np.arange(len(data)) + np.repeat(starts + 1 - (at[:-1] - at[0]), size)] = data
    owner = np.repeat(np.arange(n), size + 2)
    found, whose = [], []
    for k in NGRAMS:
        if len(flat) < k:
            break
        value = np.full(len(flat) - k + 1, k, np.uint64)
        for j in range(k):
            value = (value << np.uint64(8)) | flat[j:len(flat) - k + 1 + j]
        inside = owner[:len(value)] == owner[k - 1:]
        found.append((mix64(value[inside]) % np.uint64(BUCKETS)).astype(np.int64))
        whose.append(owner[:len(value)][inside])
    hashed = hashes_of(words)
    place = np.minimum(np.searchsorted(lexicon, hashed), max(len(lexicon) - 1, 0))
    listed = np.flatnonzero(lexicon[place] == hashed) if len(lexicon) else np.empty(0, np.int64)
    found.append(BUCKETS + place[listed])
    whose.append(listed)
    features, whose_ = np.concatenate(found), np.concatenate(whose)
    order = np.argsort(whose_, kind="stable")
    return features[order], np.concatenate([[0], np.cumsum(np.bincount(whose_, minlength=n))])


class LanguageField:
    """Labels, feature weights (features x labels) and transition weights."""

    def __init__(self, labels: list[str], lexicon: np.ndarray):
        k = len(labels)
        self.labels, self.lexicon = labels, lexicon
        self.weights = np.zeros((BUCKETS + len(lexicon), k), np.float32)
        self.transitions, self.start = np.zeros((k, k)), np.zeros(k)

    def emissions(self, words: pa.Array) -> np.ndarray:
        """Scores of distinct words, some thousands at a time."""
        out = np.empty((len(words), len(self.labels)), np.float32)
        for a in range(0, len(out), WORDS):
            features, offsets = word_features(words.slice(a, WORDS), self.lexicon)
            out[a:a + WORDS] = np.add.reduceat(self.weights[features], offsets[:-1], axis=0)  # every word has features
        return out

    def shares(self, scores: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Sums of the label probabilities of each text's words, given the
        scores of distinct words. Marginals are worked out for runs of whole
        texts of about ``CELLS`` places, to which segments are filled up, so
        that memory follows neither the number of texts nor that of words; a
        longer text is a run of its own."""
        n, k = len(offsets) - 1, scores.shape[1]
        out = np.zeros((n, k))
        ends = np.cumsum(-(-np.diff(offsets) // SEGMENT) * SEGMENT * k)
        a = 0
        while a < n:
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CELLS, side="right")))
            at = offsets[a:b + 1] - offsets[a]
            p = self.marginals(scores[codes[offsets[a]:offsets[b]]], at)
            row = np.repeat(np.arange(b - a), np.diff(at))
            out[a:b] = np.column_stack([np.bincount(row, weights=p[:, j], minlength=b - a) for j in range(k)])
            a = b
        return out

    def marginals(self, emissions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Label probabilities of every word, given whole texts (word scores by
        text), by forward-backward."""
        n, k = emissions.shape
        emissions = emissions.astype(np.float64)
        e = np.exp(emissions - emissions.max(axis=1, keepdims=True)) if n else emissions
        e = np.vstack([e, np.ones((1, k))])
        a = np.exp(self.transitions - self.transitions.max())
        size = np.diff(offsets)
        parts = -(-size // SEGMENT)
        text = np.repeat(np.arange(len(size)), parts)
        order = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = offsets[:-1][text] + order * SEGMENT
        length = np.minimum(size[text] - order * SEGMENT, SEGMENT)
        first = order == 0
        at = np.where(np.arange(SEGMENT)[None, :] < length[:, None], begin[:, None] + np.arange(SEGMENT), n)

        def scaled(v: np.ndarray) -> np.ndarray:
            return v / v.max(axis=tuple(range(1, v.ndim)), keepdims=True)

        # transfer matrices of segments; a text's first word has no transition
        m = np.broadcast_to(np.eye(k), (len(text), k, k)).copy()
        for t in range(SEGMENT):
            on = np.flatnonzero(length > t)
            if not len(on):
                break
            step = m[on] @ a
            if t == 0:
                step[first[on]] = m[on][first[on]]
            m[on] = scaled(step * e[at[on, t]][:, None, :])
        # messages at segment borders, all texts side by side
        before, after = np.empty((len(text), k)), np.ones((len(text), k))
        longest = int(parts.max()) if len(parts) else 0
        head = np.cumsum(parts) - parts
        v = np.broadcast_to(np.exp(self.start - self.start.max()), (len(size), k)).copy()
        for s in range(longest):
            on = np.flatnonzero(parts > s)
            seg = head[on] + s
            before[seg] = v[on]
            v[on] = scaled(np.einsum("ij,ijk->ik", v[on], m[seg]))
        b = np.ones((len(size), k))
        for s in range(longest - 1, -1, -1):
            on = np.flatnonzero(parts > s)
            seg = head[on] + s
            after[seg] = b[on]
            b[on] = scaled(np.einsum("ijk,ik->ij", m[seg], b[on]))
        out = np.empty((n + 1, k))
        v = before
        for t in range(SEGMENT):
            on = np.flatnonzero(length > t)
            step = v[on] if t == 0 else v[on] @ a
            if t == 0:
                step = np.where(first[on][:, None], step, step @ a)
            v[on] = scaled(step * e[at[on, t]])
            out[at[on, t]] = v[on]
        b = after
        for t in range(SEGMENT - 1, -1, -1):
            on = np.flatnonzero(length > t)
            out[at[on, t]] *= b[on]
            b[on] = scaled((e[at[on, t]] * b[on]) @ a.T)
        out = out[:n]
        return out / out.sum(axis=1, keepdims=True) if n else out


def training_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """What ``words_of`` gives, from some texts at a time: words are numbered
    as they first occur."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    parts, counts = [], [np.zeros(1, np.int64)]
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CUT_CHARS, side="right")))
        codes, words, offsets = words_of(texts.slice(a, b - a))
        parts.append(pa.DictionaryArray.from_arrays(pa.array(codes.astype(np.int32)), words))
        counts.append(np.diff(offsets))
        a = b
    if not parts:
        return words_of(texts)
    coded = pa.chunked_array(parts).unify_dictionaries()
    codes = np.concatenate([c.indices.to_numpy() for c in coded.chunks])
    return codes, coded.chunk(0).dictionary, np.cumsum(np.concatenate(counts))


def features_of(words: pa.Array, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``word_features`` of many words, some thousands at a time."""
    found, counts = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
    for a in range(0, len(words), WORDS):
        features, offsets = word_features(words.slice(a, WORDS), lexicon)
        found.append(features.astype(np.int32))
        counts.append(np.diff(offsets))
    return np.concatenate(found), np.cumsum(np.concatenate(counts))


def fit(texts: pa.Array, langs: list[str], sequences: int = 4000, rounds: int = 60, l2: float = 1e-4, seed: int = 7) -> LanguageField:
    """A field from texts of known language. ``sequences`` label sequences of
    SEGMENT words are drawn, each of one to three runs from random texts
    (languages drawn alike); all of their words are used."""
    labels = sorted(set(langs))
    codes, words, offsets = training_words(texts)
    size = np.diff(offsets)
    y = np.array([labels.index(x) for x in langs], np.int64)
    usable = [np.flatnonzero((y == i) & (size > 0)) for i in range(len(labels))]
    labels = [x for x, u in zip(labels, usable) if len(u)]
    usable = [u for u in usable if len(u)]
    hashed = hashes_of(words)
    often = np.bincount(codes, minlength=len(words))
    top = np.argsort(-often, kind="stable")[:LEXICON]
    field = LanguageField(labels, np.sort(hashed[top]))
    if len(labels) < 2:
        return field
    rng = np.random.default_rng(seed)
    rows, tags = np.zeros((sequences, SEGMENT), np.int64), np.zeros((sequences, SEGMENT), np.int64)
    for i in range(sequences):
        runs = int(rng.choice([1, 2, 3], p=[0.7, 0.2, 0.1]))
        cuts = [0, *sorted(rng.choice(np.arange(8, SEGMENT - 8), runs - 1, replace=False).tolist()), SEGMENT]
        for a, b in zip(cuts, cuts[1:]):
            k = int(rng.integers(len(labels)))
            while a < b:
                t = int(rng.choice(usable[k]))
                s = offsets[t] + int(rng.integers(max(1, size[t] - (b - a) + 1)))
                got = codes[s:min(s + b - a, offsets[t + 1])]
                rows[i, a:a + len(got)], tags[i, a:a + len(got)] = got, k
                a += len(got)
    used, rows = np.unique(rows, return_inverse=True)
    rows = rows.reshape(tags.shape)
    features, ends = features_of(words.take(pa.array(used)), field.lexicon)
    owner = np.repeat(np.arange(len(used), dtype=np.int32), np.diff(ends))
    del codes, words, hashed, often, top
    give_back()
    k, n = len(labels), tags.size
    true = np.zeros((len(used), k))
    np.add.at(true, (rows.ravel(), tags.ravel()), 1)
    true_pairs = np.zeros((k, k))
    np.add.at(true_pairs, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
    weights, trans = np.zeros((len(field.weights), k)), np.zeros((k, k))
    seen_w, seen_t = np.full(weights.shape, 1e-8), np.full(trans.shape, 1e-8)
    for _ in range(rounds):
        score = np.concatenate([np.add.reduceat(weights[features[ends[a]:ends[min(a + WORDS, len(used))]]], ends[a:min(a + WORDS, len(used))] - ends[a], axis=0)
                                for a in range(0, len(used), WORDS)])
        e = np.exp(score - score.max(axis=1, keepdims=True))[rows]
        a = np.exp(trans)
        alpha, beta = np.empty(e.shape), np.ones(e.shape)
        alpha[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, SEGMENT):
            v = (alpha[:, t - 1] @ a) * e[:, t]
            alpha[:, t] = v / v.sum(axis=1, keepdims=True)
        pairs = np.zeros((k, k))
        for t in range(SEGMENT - 1, 0, -1):
            w = e[:, t] * beta[:, t]
            v = w @ a.T
            joint = alpha[:, t - 1][:, :, None] * a[None] * w[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            beta[:, t - 1] = v / v.sum(axis=1, keepdims=True)
        p = alpha * beta
        p /= p.sum(axis=2, keepdims=True)
        residual = true - np.column_stack([np.bincount(rows.ravel(), weights=p[:, :, j].ravel(), minlength=len(used)) for j in range(k)])
        grad = np.column_stack([np.bincount(features, weights=residual[owner, j], minlength=len(weights)) for j in range(k)]) / n - l2 * weights
        grad_t = (true_pairs - pairs) / n - l2 * trans
        seen_w += grad ** 2
        seen_t += grad_t ** 2
        weights += 0.3 * grad / np.sqrt(seen_w)
        trans += 0.3 * grad_t / np.sqrt(seen_t)
    field.weights, field.transitions = weights.astype(np.float32), trans
    return field


def train(docs: DataFrame, learn: Column, train_rows: int = 4000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          stretch: int = 20_000) -> LanguageField:
    """A field from documents of known language for which ``learn`` holds: of
    every language an equal share of ``train_rows`` (one document at least),
    those that come first by a hash of id and text; repeated ones count once.
    Of a text of more than ``stretch`` characters a stretch of that length
    counts, from a place that the hash gives. So the driver, which fits the
    field, holds at most train_rows x ``stretch`` characters, whatever the
    lengths, and a language that few or only long texts have is learnt."""
    known = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).cast("string").alias("text"))
    each = known.select("lang", "h").distinct()
    langs = each.select("lang").distinct().count()
    if not langs:
        return fit(pa.array([], pa.string()), [])
    # the hash that a language's last row has; texts move only below it
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    last = each.withColumn("n", place).where(F.col("n") <= max(1, train_rows // langs)).groupBy("lang").agg(F.max("h").alias("last"))
    spare = F.greatest(F.length("text") - stretch, F.lit(0))
    cut = F.substring(F.col("text"), (F.pmod("h", spare + 1) + 1).cast("int"), F.lit(stretch))
    rows = (known.join(F.broadcast(last), "lang").where("h <= last").select("lang", "h", cut.alias("text")).dropDuplicates(["lang", "h"])
            .toArrow().sort_by([("h", "ascending"), ("lang", "ascending")]))
    return fit(one_array(rows.column("text")).cast(pa.string()) if rows.num_rows else pa.array([], pa.string()), rows.column("lang").to_pylist())


def predict_block(field: LanguageField, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text: the label with the largest share of its
    words with letters, and that share."""
    codes, words, offsets = words_of(texts)
    n, k = len(offsets) - 1, len(field.labels)
    if not k:
        return [UNKNOWN] * n, np.zeros(n)
    lettered = pc.match_substring_regex(words, r"\pL").to_numpy(zero_copy_only=False)
    kept = lettered[codes]
    row = np.repeat(np.arange(n), np.diff(offsets))
    count = np.bincount(row[kept], minlength=n)
    share = field.shares(field.emissions(words), codes[kept], np.concatenate([[0], np.cumsum(count)])) / np.maximum(count, 1)[:, None]
    best = share.argmax(axis=1)
    return [field.labels[b] if c else UNKNOWN for b, c in zip(best, count)], np.where(count > 0, np.clip(share.max(axis=1), 0, 1), 0.0)


def predict(docs: DataFrame, field: LanguageField, text_col: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with ``out`` (a learned language, or
    ``und`` where the text is null or has no letter) and ``score`` (0 to 1).
    Repeated rows get the same result; an empty table gives an empty result;
    columns named as the new ones are replaced."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(field)
    docs = docs.drop(out, score)
    shape = T.StructType([*docs.schema.fields, T.StructField(out, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col, PREDICT_BLOCK_BYTES):
            langs, scores = predict_block(shared.value, texts_of(block, text_col))
            yield from block.append_column(out, pa.array(langs, pa.string())).append_column(score, pa.array(scores)).to_batches()

    return docs.mapInArrow(run, shape)
