"""Probabilistic suffix tree over words, for scoring text.

A text is its words (A-Z lower-cased) and one end mark; the tree's symbols are
the words themselves. A *context* is a run of at most ``depth`` words before the
next one, the first of which may be the start of the text. It becomes a state of
the tree if it occurs ``least_count`` times in training and its next-word
distribution diverges from that of its longest state suffix: count x
Kullback-Leibler divergence (in nats) must reach ``divergence`` for every word
seen after it. Both are evidence in absolute terms, so a context kept on a small
corpus is kept on a larger one that holds it as often. Distributions are
smoothed with those of the suffix, in proportion to the number of distinct words
seen (Witten-Bell). A token is scored in the longest state that is a suffix of
what stands before it.

What the shortest states are smoothed with must give every word a place, also
one that training hasn't seen. It is P(class | class before) x P(word | class)
for a bounded set of word *classes*, given by a word's last ``TAIL`` bytes and
length: the first factor is a tree over contexts of at most SHORT classes,
smoothed down to the uniform distribution; the second is the smoothed share of
the word in its class, one place kept for unseen words. The probabilities of all
words and the end mark sum to one after any context.

What is gathered from the corpus (words, and runs of words, with their counts)
is summed by Spark and grows with it, and so does the tree. Only the tree of
classes, SYMBOLS of them, is fit on the driver and broadcast. Words, identified
by 64-bit hashes, are counted in buckets by ranges of the hash, and get numbers
there. Contexts are then settled by length. Blocks (``BLOCK_BYTES`` of text)
send their distinct runs (a context's number, the next word's, training count,
probability so far) to the context's bucket, which settles whether it is a state
and answers with the runs' scores; a run that occurs ``least_count`` times gets
a number as a context of the next length. No context that occurs less often can
be a state, nor can a longer one that ends with it, so its tokens are done. A context
that occurs more than HOT times is dealt over several buckets by the next word,
and its totals are added up first. What moves is one compressed row per block
and bucket. The number of buckets follows the bytes of text.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_run_dir
from .common import blocks, give_back, hashes_of, mix64, one_array, prepare, texts_of, words_of

#: bits of a symbol; symbol 0 is the end mark, also before the start of a text
BITS = 9
SYMBOLS = 1 << BITS
#: last bytes of a word that tell its class
TAIL = 2
#: longest context of classes, whose distributions the driver fits; text bytes of a bucket
SHORT, BUCKET_BYTES = 1, 4 << 20
#: a run is its context's number, in how many buckets that is dealt (4 ** spread), and its next word's number
NEXT_BITS, SPREAD_BITS, RUN_BITS = 30, 3, 64
#: occurrences of a context in one bucket
HOT = 1 << 20
#: tokens in a stored piece of a block; steps in which scores travel
PIECE, SCORE = 1 << 18, 1 << 20
#: blocks meet their answers in up to so many parts, one after another, each of so many buckets' text at least
PARTS, PART_BUCKETS = 4, 8


def word_classes(words: pa.Array) -> np.ndarray:
    """Symbols (1 to SYMBOLS - 1) of distinct words."""
    words = words.cast(pa.binary())
    if not len(words):
        return np.empty(0, np.int64)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    raw = np.frombuffer(words.buffers()[2], np.uint8)
    size = np.diff(ends)
    key = np.minimum(size, TAIL + 1).astype(np.uint64)
    for k in range(TAIL):
        last = np.where(size > k, raw[np.maximum(ends[1:] - 1 - k, 0)], 0)
        key = (key << np.uint64(8)) | last.astype(np.uint64)
    return (mix64(key) % np.uint64(SYMBOLS - 1)).astype(np.int64) + 1


def class_runs(symbols: np.ndarray, offsets: np.ndarray, depth: int) -> np.ndarray:
    """Per token, the end mark of each text included, the ``depth`` symbols
    before it and its own, packed. ``symbols`` are the words' by text."""
    texts = len(offsets) - 1
    sizes = np.diff(offsets)
    flat = np.zeros(len(symbols) + texts * (depth + 1), np.int64)
    starts = offsets[:-1] - offsets[0] + np.arange(texts) * (depth + 1)
    flat[np.arange(len(symbols)) + np.repeat((np.arange(texts) + 1) * (depth + 1) - 1, sizes)] = symbols
    here = np.ones(len(flat), bool)
    here[(starts[:, None] + np.arange(depth)).ravel()] = False
    place = np.flatnonzero(here)
    runs = np.zeros(len(place), np.int64)
    for k in range(depth, -1, -1):
        runs = (runs << BITS) | flat[place - k]
    return runs


class SuffixTree:
    """States by depth, their next-symbol log10 probabilities, and the log10
    weight that each gives to its suffix for symbols it hasn't seen."""

    def __init__(self, depth: int):
        self.depth = depth
        self.states: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self.runs: list[np.ndarray] = []
        self.values: list[np.ndarray] = []

    def log10(self, runs: np.ndarray, longest: int | None = None) -> np.ndarray:
        """log10 probability of each run's last symbol in the longest state
        (of at most ``longest`` symbols) that its context ends with."""
        out = np.zeros(len(runs))
        open_ = np.arange(len(runs))
        for k in range(self.depth if longest is None else longest, -1, -1):
            if not len(self.states[k]):
                continue
            mine = runs[open_] & ((1 << BITS * (k + 1)) - 1)
            context = mine >> BITS
            at = np.minimum(np.searchsorted(self.states[k], context), len(self.states[k]) - 1)
            state = self.states[k][at] == context
            key = np.minimum(np.searchsorted(self.runs[k], mine), len(self.runs[k]) - 1)
            seen = state & (self.runs[k][key] == mine)
            out[open_[seen]] += self.values[k][key[seen]]
            miss = state & ~seen
            out[open_[miss]] += self.weights[k][at[miss]]
            open_ = open_[~seen]
        out[open_] -= np.log10(SYMBOLS)
        return out


def fit(levels: list[tuple[np.ndarray, np.ndarray]], depth: int, divergence: float, least_count: int = 1) -> SuffixTree:
    """The tree from, per depth k, the runs of k context symbols and one more
    (sorted) with their counts."""
    tree = SuffixTree(depth)
    for k, (runs, counts) in enumerate(levels):
        states, first, kinds = np.unique(runs >> BITS, return_index=True, return_counts=True)
        total = np.add.reduceat(counts, first) if len(first) else np.empty(0)
        owner = np.repeat(np.arange(len(states)), kinds)
        n, t = total[owner].astype(float), kinds[owner].astype(float)
        suffix = 10.0 ** tree.log10(runs, k - 1) if k else np.full(len(runs), 1 / SYMBOLS)
        p = (counts + t * suffix) / (n + t)
        gain = np.bincount(owner, weights=counts * np.log(p / suffix), minlength=len(states))
        keep = (gain >= divergence * kinds) & (total >= least_count) if k else np.ones(len(states), bool)
        tree.states.append(states[keep])
        tree.weights.append(np.log10(kinds[keep] / (total[keep] + kinds[keep])))
        tree.runs.append(runs[keep[owner]])
        tree.values.append(np.log10(p[keep[owner]]))
    return tree


def totals(owner: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens after each context, and distinct ones, from its runs' counts."""
    return np.bincount(owner, weights=counts, minlength=size), np.bincount(owner, weights=counts > 0, minlength=size)


def smoothed(counts: np.ndarray, total: np.ndarray, kinds: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Probabilities of runs whose contexts have these totals."""
    return np.where(total > 0, (counts + kinds * suffix) / np.maximum(total + kinds, 1), suffix)


def diverging(total: np.ndarray, kinds: np.ndarray, gain: np.ndarray, divergence: float, least_count: int) -> np.ndarray:
    """Which contexts are states; ``gain`` is count x divergence."""
    return (total > 0) & (total >= least_count) & (gain >= divergence * kinds)


def lengthened(low: SuffixTree, runs: np.ndarray, counts: np.ndarray, depth: int, divergence: float, least_count: int) -> np.ndarray:
    """log10 probability of the last symbol of each run (distinct; training
    count 0 for one that is only asked for) in its longest state. All runs
    that share the last SHORT + 1 context symbols with one of them are there.
    For runs of classes; those of words are settled in ``settled_runs``."""
    out = low.log10(runs & ((1 << BITS * (low.depth + 1)) - 1))
    for k in range(low.depth + 1, depth + 1):
        own, which = np.unique(runs & ((1 << BITS * (k + 1)) - 1), return_inverse=True)
        n = np.bincount(which, weights=counts, minlength=len(own))
        below = np.empty(len(own))
        below[which] = out  # runs that are one at this length have one suffix
        suffix = 10.0 ** below
        states, owner = np.unique(own >> BITS, return_inverse=True)
        total, kinds = totals(owner, n, len(states))
        p = smoothed(n, total[owner], kinds[owner], suffix)
        gain = np.bincount(owner, weights=n * np.log(p / suffix), minlength=len(states))
        state = diverging(total, kinds, gain, divergence, least_count)
        out = np.where(state[owner], np.log10(p), below)[which]
    return out


def buckets_of(runs: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each run of classes, by the last SHORT + 1 symbols of its context."""
    context = (runs >> BITS) & ((1 << BITS * (SHORT + 1)) - 1)
    return (mix64(context.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def spread_of(counts: np.ndarray, hot: int) -> np.ndarray:
    """Contexts that occur so often are dealt over 4 ** spread buckets, for about ``hot`` occurrences in each."""
    return np.minimum(np.ceil(np.log2(np.maximum(counts / hot, 1)) / 2), (1 << SPREAD_BITS) - 1).astype(np.uint64)


def numbered(rank: np.ndarray, bucket: np.ndarray | int, buckets: int, bits: int) -> np.ndarray:
    """Numbers (from 1) of what has a rank (from 0) in one of so many buckets."""
    numbers = rank.astype(np.int64) * buckets + bucket + 1
    if len(numbers) and int(numbers.max()) >> bits:
        raise ValueError(f"more than 2 ** {bits} words or contexts")
    return numbers.astype(np.uint64)


def contexts_of(numbers: np.ndarray, spread: np.ndarray | int) -> np.ndarray:
    return (numbers << np.uint64(SPREAD_BITS)) | np.asarray(spread, np.uint64)


def runs_of(contexts: np.ndarray, following: np.ndarray) -> np.ndarray:
    return (contexts << np.uint64(NEXT_BITS)) | following.astype(np.uint64)


def run_parts(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(contexts, next words' numbers)"""
    return runs >> np.uint64(NEXT_BITS), runs & np.uint64((1 << NEXT_BITS) - 1)


def dealt(runs: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each run, by its context; those of contexts that are dealt over
    several buckets, by the next word too, have buckets of their own, from ``buckets`` on."""
    contexts, following = run_parts(runs)
    spread = contexts & np.uint64((1 << SPREAD_BITS) - 1)
    part = mix64(following) & ((np.uint64(1) << (spread * np.uint64(2))) - np.uint64(1))
    bucket = mix64(mix64(contexts) + part) % np.uint64(buckets)
    return (bucket + np.where(spread > 0, np.uint64(buckets), np.uint64(0))).astype(np.int32)


def distinct_of(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct runs, place of each run among them)"""
    order = np.argsort(runs)
    runs = runs[order]
    new = np.empty(len(runs), bool)
    new[:1], new[1:] = True, runs[1:] != runs[:-1]
    which = np.empty(len(runs), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - 1
    return runs[new], which


def packed(values: np.ndarray) -> bytes:
    """Integers as compressed planes of their bytes."""
    return pa.compress(values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<i8").ravel()


def packed_scores(values: np.ndarray) -> bytes:
    """Scores in steps of 1 / SCORE, which for log10 probabilities are no coarser
    than single precision's, but leave fewer odd bits; compressed."""
    whole = np.rint(values * SCORE).astype("<i4")
    return pa.compress(whole.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpacked_scores(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").ravel() / SCORE


def gathered(rows: DataFrame, low: int, buckets: int) -> DataFrame:
    """One pass over the text, three kinds of rows. ``kind`` 0: a document, its
    block and its ``n`` words' codes in the block, packed; 1: a block's
    distinct words in one bucket, ``n`` of them, in the order of their codes:
    packed steps of their hashes, and training counts with classes (count x
    SYMBOLS + class); 3: a run of ``low`` context classes with its training
    count."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    shape = f"kind int, block long, doc_id {id_type}, held_out boolean, bucket int, run long, n long, keys binary, counts binary"
    types = {"kind": pa.int32(), "block": pa.int64(), "held_out": pa.bool_(), "bucket": pa.int32(), "run": pa.int64(), "n": pa.int64(),
             "keys": pa.binary(), "counts": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            ids = one_array(block.column("doc_id"))
            made = row_maker(shape, {**types, "doc_id": ids.type})
            held = one_array(block.column("held_out")).to_numpy(zero_copy_only=False)
            codes, words, offsets = words_of(texts_of(block, "text"))
            # the rows are stored at once, so a block's mark is settled with them
            mark = uuid.uuid4().int >> 65

            hashed = hashes_of(words)
            order = np.argsort(hashed, kind="stable")
            hashed, symbols = hashed[order], word_classes(words)[order]
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            codes = rank[codes]
            distinct = len(words)
            del words, rank, order, block
            give_back()
            for a in range(0, len(held), 256):
                listed = [packed(codes[x:y]) for x, y in zip(offsets[a:a + 256], offsets[a + 1:a + 257])]
                yield made(len(listed), kind=0, block=mark, doc_id=ids.slice(a, 256), held_out=held[a:a + 256],
                           n=np.diff(offsets[a:a + 257]), keys=listed)
            train = np.bincount(codes[np.repeat(~held, np.diff(offsets))], minlength=distinct)
            bucket = ((hashed >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            given = (train << BITS) | symbols
            for own, spans in spans_of(bucket):
                yield made(len(spans), kind=1, block=mark, bucket=own, n=[y - x for x, y in spans],
                           keys=[packed(np.diff(hashed[x:y].view(np.int64), prepend=0)) for x, y in spans], counts=[packed(given[x:y]) for x, y in spans])
            runs = class_runs(symbols[codes], offsets, low)
            short = np.bincount(runs[np.repeat(~held, np.diff(offsets) + 1)], minlength=SYMBOLS ** (low + 1))
            del codes, runs
            own = np.flatnonzero(short)
            step = 1 << 17
            for a in range(0, len(own), step):
                yield made(len(own[a:a + step]), kind=3, run=own[a:a + step], n=short[own[a:a + step]])

    return rows.mapInArrow(run, shape)


def row_maker(shape: str, types: dict[str, pa.DataType]):
    """Makes batches of rows with null in the columns that aren't given; one
    number is every row's."""
    names = [s.split()[0] for s in shape.split(", ")]

    def column(name: str, rows: int, given) -> pa.Array:
        if given is None:
            return pa.nulls(rows, types[name])
        if isinstance(given, int):
            given = np.full(rows, given)
        return given if isinstance(given, pa.Array) else pa.array(given, types[name])

    def made(rows: int, **given) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([column(c, rows, given.get(c)) for c in names], names=names)
    return made


def spans_of(bucket: np.ndarray) -> Iterator[tuple[np.ndarray, list[tuple[int, int]]]]:
    """(buckets, their spans) of sorted buckets, up to 256 at once."""
    own, first = np.unique(bucket, return_index=True)
    ends = [*first.tolist(), len(bucket)]
    for a in range(0, len(own), 256):
        yield own[a:a + 256], list(zip(ends, ends[1:]))[a:a + 256]


def levels_of(runs: DataFrame, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """By length, the counts of the runs of at most SHORT context symbols:
    SYMBOLS ** (SHORT + 1) of them at most."""
    got = runs.groupBy("run").agg(F.sum("n").alias("n")).toArrow()
    runs_, counts = one_array(got.column("run")).to_numpy(), one_array(got.column("n")).to_numpy()
    out = []
    for k in range(depth + 1):
        keys, which = np.unique(runs_ & ((1 << BITS * (k + 1)) - 1), return_inverse=True)
        out.append((keys, np.bincount(which, weights=counts).astype(np.int64)))
    return out


def lists_of(table: pa.Table, column: str) -> np.ndarray:
    """The packed lists of a column, one after another."""
    lists = [unpacked(x.as_py(), n) for x, n in zip(table.column(column), table.column("n").to_pylist())]
    return np.concatenate(lists) if lists else np.empty(0, np.int64)


def scores_of(table: pa.Table, column: str) -> np.ndarray:
    """The packed scores of a column, one list after another."""
    lists = [unpacked_scores(x.as_py(), n) for x, n in zip(table.column(column), table.column("n").to_pylist())]
    return np.concatenate(lists) if lists else np.empty(0)


def keys_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, place of each key among them, ends per row)."""
    lists = [np.cumsum(unpacked(x.as_py(), n)) for x, n in zip(table.column("keys"), table.column("n").to_pylist())]
    return (*np.unique(np.concatenate(lists), return_inverse=True), np.cumsum([len(x) for x in lists]))


def ranked(counts: np.ndarray) -> np.ndarray:
    """Ranks from 0, the most frequent first."""
    out = np.empty(len(counts), np.int64)
    out[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    return out


def counted_words(found: DataFrame) -> DataFrame:
    """block, bucket, n, answer, ranks: counts and classes of a block's words in
    the bucket (count x SYMBOLS + class, packed), and their ranks there. And
    rows of symbol, n, kinds: by bucket and class, training tokens and distinct
    words of training."""
    def run(table: pa.Table) -> pa.Table:
        give_back()
        distinct, which, ends = keys_of(table)
        given = lists_of(table, "counts")
        symbols = np.zeros(len(distinct), np.int64)
        symbols[which] = given & (SYMBOLS - 1)
        count = np.bincount(which, weights=given >> BITS, minlength=len(distinct)).astype(np.int64)
        value, rank = (count << BITS) | symbols, ranked(count)
        n, kinds = np.bincount(symbols, weights=count, minlength=SYMBOLS), np.bincount(symbols[count > 0], minlength=SYMBOLS)
        own, sizes = np.flatnonzero(kinds), table.column("n").to_numpy()
        rows, more = table.num_rows, len(own)
        return pa.table({
            "block": pa.array([*table.column("block").to_pylist(), *[None] * more], pa.int64()),
            "bucket": pa.array([*table.column("bucket").to_pylist(), *[None] * more], pa.int32()),
            "n": pa.array([*sizes.tolist(), *n[own].astype(np.int64).tolist()], pa.int64()),
            "answer": pa.array([*[packed(value[which[b - x:b]]) for b, x in zip(ends, sizes)], *[None] * more], pa.binary()),
            "ranks": pa.array([*[packed(rank[which[b - x:b]]) for b, x in zip(ends, sizes)], *[None] * more], pa.binary()),
            "symbol": pa.array([*[None] * rows, *own.tolist()], pa.int32()),
            "kinds": pa.array([*[None] * rows, *kinds[own].tolist()], pa.int64())})

    asked = found.where("kind = 1").select("block", "bucket", "n", "keys", "counts")
    return asked.groupBy("bucket").applyInArrow(run, "block long, bucket int, n long, answer binary, ranks binary, symbol int, kinds long")


#: rows of a level. ``kind`` 0: ``n`` of a block's open tokens, in pieces: packed steps of their places, and their runs'
#: places among the block's distinct runs; 1: a block's distinct runs in one bucket, ``n`` of them: packed steps, training
#: counts, scores in shorter contexts; 2: a document, the ``at``-th of its block, with the score of its tokens that are done
LEVEL = "kind int, block long, at int, bucket int, n long, keys binary, counts binary, below binary, held_out boolean, known long, base double, score double"
TYPES = {"kind": pa.int32(), "block": pa.int64(), "at": pa.int32(), "bucket": pa.int32(), "n": pa.int64(), "keys": pa.binary(), "counts": pa.binary(),
         "below": pa.binary(), "held_out": pa.bool_(), "known": pa.int64(), "base": pa.float64(), "score": pa.float64()}


def level_rows(shape: str, mark: int, docs: dict, places: np.ndarray, runs: np.ndarray, below: np.ndarray, buckets: int) -> pa.Table:
    """A block's rows: ``docs`` are its documents' columns, ``places`` its open
    tokens in the order of the text, ``runs`` and ``below`` theirs."""
    made = row_maker(shape, {**TYPES, "doc_id": docs["doc_id"].type})
    texts = len(docs["n"])
    out = [made(texts, kind=2, block=mark, at=np.arange(texts), **docs)]
    training = ~np.repeat(docs["held_out"], docs["n"])[places]
    runs, which = distinct_of(runs)
    bucket = dealt(runs, buckets)
    order = np.argsort(bucket, kind="stable")
    runs, bucket = runs[order], bucket[order]
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    which = place[which]
    del order, place
    score = np.empty(len(runs))
    score[which] = below  # one run has one suffix
    counts = np.bincount(which[training], minlength=len(runs))
    cuts = range(0, len(places), PIECE)
    out.append(made(len(cuts), kind=0, block=mark, at=np.arange(len(cuts)), n=[len(places[a:a + PIECE]) for a in cuts],
                    keys=[packed(np.diff(places[a:a + PIECE], prepend=0)) for a in cuts], counts=[packed(which[a:a + PIECE]) for a in cuts]))
    for own, spans in spans_of(bucket):
        out.append(made(len(spans), kind=1, block=mark, bucket=own, n=[y - x for x, y in spans],
                        keys=[packed(np.diff(runs[x:y].view(np.int64), prepend=0)) for x, y in spans], counts=[packed(counts[x:y]) for x, y in spans],
                        below=[packed_scores(score[x:y]) for x, y in spans]))
    return pa.Table.from_batches(out)


def settled_runs(runs: DataFrame, buckets: int, divergence: float, least_count: int, hot: int, last: bool) -> DataFrame:
    """block, bucket, n, scores, ranks, following: the scores of a block's runs
    in the bucket, in their order, and their next words. ``ranks``: 0, or for a
    run that is a context of the next length its rank (from 1) in the bucket, with its spread."""
    asked = runs.select("block", "bucket", "n", "keys", "counts", "below")
    spark = runs.sparkSession

    def known(table: pa.Table) -> tuple:
        """(distinct runs, place of each, ends by row, counts, suffixes' probabilities, contexts, context of each run)"""
        give_back()
        runs, which, ends = keys_of(table)
        counts = np.bincount(which, weights=lists_of(table, "counts"), minlength=len(runs))
        suffix = np.empty(len(runs))
        suffix[which] = 10.0 ** scores_of(table, "below")
        runs = runs.view(np.uint64)
        return (runs, which, ends, counts, suffix, *np.unique(run_parts(runs)[0], return_inverse=True))

    def gains(owner: np.ndarray, counts: np.ndarray, p: np.ndarray, suffix: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(owner, weights=counts * np.log(p / suffix), minlength=size)

    def some_totals(table: pa.Table) -> pa.Table:
        *_, counts, _, contexts, owner = known(table)
        total, kinds = totals(owner, counts, len(contexts))
        return pa.table({"context": contexts.view(np.int64), "total": total, "kinds": kinds})

    def some_gains(table: pa.Table) -> pa.Table:
        *_, counts, suffix, contexts, owner = known(table)
        total, kinds = (x[np.searchsorted(sums.value[0], contexts)] for x in sums.value[1:])
        p = smoothed(counts, total[owner], kinds[owner], suffix)
        return pa.table({"context": contexts.view(np.int64), "gain": gains(owner, counts, p, suffix, len(contexts))})

    # totals of the contexts that are dealt over several buckets; each has more than ``hot`` occurrences, so they are few
    several = asked.where(F.col("bucket") >= buckets).groupBy("bucket")
    got = several.applyInArrow(some_totals, "context long, total double, kinds double").groupBy("context") \
        .agg(F.sum("total").alias("total"), F.sum("kinds").alias("kinds")).toArrow()
    contexts = one_array(got.column("context")).to_numpy().view(np.uint64)
    order = np.argsort(contexts)
    dealt_out = [contexts[order], *(one_array(got.column(c)).to_numpy()[order] for c in ("total", "kinds"))]
    state = np.zeros(len(order), bool)
    if len(order):
        sums = spark.sparkContext.broadcast(dealt_out)
        got = several.applyInArrow(some_gains, "context long, gain double").groupBy("context").agg(F.sum("gain").alias("gain")).toArrow()
        gain = np.zeros(len(order))
        gain[np.searchsorted(dealt_out[0], one_array(got.column("context")).to_numpy().view(np.uint64))] = one_array(got.column("gain")).to_numpy()
        state = diverging(*dealt_out[1:], gain, divergence, least_count)
    whole = spark.sparkContext.broadcast([*dealt_out, state])
    frequent = max(1, least_count)

    def run(table: pa.Table) -> pa.Table:
        runs, which, ends, counts, suffix, contexts, owner = known(table)
        if table.column("bucket")[0].as_py() >= buckets:
            total, kinds, state = (x[np.searchsorted(whole.value[0], contexts)] for x in whole.value[1:])
            p = smoothed(counts, total[owner], kinds[owner], suffix)
        else:
            total, kinds = totals(owner, counts, len(contexts))
            p = smoothed(counts, total[owner], kinds[owner], suffix)
            state = diverging(total, kinds, gains(owner, counts, p, suffix, len(contexts)), divergence, least_count)
        value = np.log10(np.where(state[owner], p, suffix))
        spans = [(b - x, b) for b, x in zip(ends.tolist(), table.column("n").to_pylist())]
        out = {c: table.column(c) for c in ("block", "bucket", "n")}
        out["scores"] = pa.array([packed_scores(value[which[a:b]]) for a, b in spans], pa.binary())
        out["ranks"] = out["following"] = pa.nulls(len(spans), pa.binary())
        if not last:
            following = run_parts(runs)[1].view(np.int64)
            own = np.flatnonzero((counts >= frequent) & (following > 0))  # nothing follows an end mark
            ranks = np.zeros(len(runs), np.int64)
            ranks[own] = contexts_of((ranked(counts[own]) + 1).astype(np.uint64), spread_of(counts[own], hot)).view(np.int64)
            out["ranks"] = pa.array([packed(ranks[which[a:b]]) for a, b in spans], pa.binary())
            out["following"] = pa.array([packed(following[which[a:b]]) for a, b in spans], pa.binary())
        return pa.table(out)

    return asked.groupBy("bucket").applyInArrow(run, "block long, bucket int, n long, scores binary, ranks binary, following binary")


class Tables:
    """Tables in the shared folder, in parts of whole blocks, each until what
    needs it is stored."""

    def __init__(self, spark, parts: int):
        self.spark, self.jvm, self.parts = spark, spark.sparkContext._jvm, parts

    def store(self, df: DataFrame, path: str) -> None:
        """Adds the rows of ``df`` to a table; parts and kinds have folders in it."""
        self.collect()
        part = F.coalesce(F.col("block") % self.parts, F.lit(0)).cast("int")
        by = ["part", *(c for c in df.columns if c == "kind")]
        df.withColumn("part", part).write.mode("append").option("compression", "zstd").partitionBy(*by).parquet(path)

    def read(self, path: str, schema, part: int | None = None) -> DataFrame:
        df = self.spark.read.schema(f"{shape_of(schema)}, part int").parquet(path)
        return (df if part is None else df.where(F.col("part") == part)).select(*schema.names)

    def drop(self, *paths: str) -> None:
        for path in map(self.jvm.org.apache.hadoop.fs.Path, paths):
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.collect()

    def collect(self) -> None:
        """Shuffle files of earlier jobs go with the objects that stand for them."""
        gc.collect()
        self.jvm.System.gc()


def shape_of(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def score_documents(docs: DataFrame, held_out: Column, depth: int = 4, least_count: int = 4, divergence: float = 1.0,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    for every row; learnt from the rows where ``held_out`` is false.

    ``base_score`` is the unigram log10 probability with 0.1 added to every
    count, ``score`` the tree's. A null or empty text is the end mark alone; a
    null id is kept, and a null ``held_out`` counts as false; repeated rows
    count as often as they occur. With no training rows the tree is the
    uniform distribution over the classes and the end mark. An empty table gives
    an empty result. Other columns are ignored. ``depth`` is at most 6.
    """
    if not 0 <= depth <= 63 // BITS - 1:
        raise ValueError("depth")
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    low, parts = min(SHORT, depth), max(1, min(PARTS, buckets // PART_BUCKETS))
    tables = Tables(spark, parts)

    def stored(df: DataFrame, name: str) -> str:
        tables.store(df, path := new_run_dir(spark, name))
        return path

    found = gathered(rows, low, buckets)
    found_at, found_schema = stored(found, "gathered"), found.schema
    found = tables.read(found_at, found_schema)
    known = counted_words(found)
    known_at, known_schema = stored(known, "word-counts"), known.schema
    known = tables.read(known_at, known_schema)
    classes = known.where("symbol IS NOT NULL").groupBy("symbol").agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds")).collect()  # at most SYMBOLS rows
    class_n, class_kinds = np.zeros(SYMBOLS), np.zeros(SYMBOLS)
    for r in classes:
        class_n[r["symbol"]], class_kinds[r["symbol"]] = r["n"], r["kinds"]
    all_tokens, ends = found.where("kind = 0").agg(F.sum(F.col("n") + 1), F.count(F.when(~F.col("held_out"), 1))).first()
    # the end mark is a token, known if there is any training text
    train_tokens, kinds = int(class_n.sum()) + ends, int(class_kinds.sum()) + (ends > 0)
    tree = fit(levels_of(found.where("kind = 3").select("run", "n"), low), low, divergence, least_count)
    by_class: Broadcast = spark.sparkContext.broadcast(tree.log10(np.arange(SYMBOLS ** (low + 1))))
    scale = float(train_tokens + 0.1 * (kinds + 1))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    shape = f"{LEVEL}, doc_id {id_type}"
    # held-out occurrences are not counted, but met
    hot = max(1, HOT * train_tokens // (all_tokens or 1))
    frequent = max(1, least_count)

    def first(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        mark, right = left.column("part")[0].as_py(), right.sort_by("bucket")
        given = lists_of(right, "answer")
        words = numbered(lists_of(right, "ranks"), np.repeat(right.column("bucket").to_numpy(), right.column("n").to_numpy()), buckets, NEXT_BITS)
        c, symbols = (given >> BITS).astype(float), given & (SYMBOLS - 1)
        sizes, texts = left.column("n").to_numpy(), left.num_rows
        offsets, codes = np.concatenate([[0], np.cumsum(sizes)]), lists_of(left, "keys")
        row = np.repeat(np.arange(texts, dtype=np.int32), sizes)
        n_known, base = (np.bincount(row, weights=of[codes], minlength=texts) for of in (c > 0, np.log10((c + 0.1) / scale)))
        below = by_class.value[class_runs(symbols[codes], offsets, low)]
        # by code + 1; 0 is the end mark, which is before the start of a text too
        inside = np.concatenate([[0.0], np.log10((c + 0.1) / (class_n[symbols] + 0.1 * (class_kinds[symbols] + 1)))])
        words, c = np.concatenate([np.zeros(1, np.uint64), words]), np.concatenate([[float(ends)], c])
        token = np.zeros(len(codes) + texts, np.int32)
        token[np.arange(len(codes)) + row] = codes + 1
        del given, codes, row
        below += inside[token]
        before = np.concatenate([np.zeros(1, np.int32), token[:-1]])
        open_ = (c >= frequent)[before] if depth else np.zeros(len(token), bool)
        doc = np.repeat(np.arange(texts, dtype=np.int32), sizes + 1)
        score = np.bincount(doc[~open_], weights=below[~open_], minlength=texts)
        places = np.flatnonzero(open_)
        runs = runs_of(contexts_of(words, spread_of(c, hot))[before[places]], words[token[places]])
        below = below[places]
        del doc, open_, token, before
        return level_rows(shape, mark, {
            "doc_id": one_array(left.column("doc_id")), "held_out": one_array(left.column("held_out")).to_numpy(zero_copy_only=False), "n": sizes + 1,
            "known": (n_known + (ends > 0)).astype(np.int64), "base": base + np.log10((ends + 0.1) / scale), "score": score}, places, runs, below, buckets)

    def longer(last: bool):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            give_back()
            mark, right = left.column("part")[0].as_py(), right.sort_by("bucket")
            pieces, texts = (left.filter(pc.equal(left.column("kind"), k)).sort_by("at") for k in (0, 2))
            docs = {c: one_array(texts.column(c)) if c == "doc_id" else texts.column(c).to_numpy() for c in ("doc_id", "held_out", "n", "known", "base", "score")}
            cuts = [np.cumsum(unpacked(x.as_py(), n)) for x, n in zip(pieces.column("keys"), pieces.column("n").to_pylist())]
            places = np.concatenate(cuts) if cuts else np.empty(0, np.int64)
            which = lists_of(pieces, "counts").astype(np.int32)
            value = scores_of(right, "scores")[which]
            doc = np.searchsorted(np.cumsum(docs["n"]), places, side="right")
            open_ = np.zeros(len(places), bool)
            if not last:
                ranks, bucket = lists_of(right, "ranks"), np.repeat(right.column("bucket").to_numpy(), right.column("n").to_numpy())
                spread, rank = ranks & ((1 << SPREAD_BITS) - 1), np.maximum((ranks >> SPREAD_BITS) - 1, 0)
                contexts = contexts_of(numbered(rank, bucket, 2 * buckets, RUN_BITS - NEXT_BITS - SPREAD_BITS), spread)
                # the token before is there, and its run is a context
                open_[1:] = (places[1:] == places[:-1] + 1) & (doc[1:] == doc[:-1]) & (ranks > 0)[which[:-1]]
            done = ~open_
            docs["score"] = docs["score"] + np.bincount(doc[done], weights=value[done], minlength=len(docs["n"]))
            at = np.flatnonzero(open_)
            runs = np.empty(0, np.uint64) if last else runs_of(contexts[which[at - 1]], lists_of(right, "following")[which[at]])
            places, value = places[at], value[at]
            del which, doc, open_, done, at, cuts
            return level_rows(shape, mark, docs, places, runs, value, buckets)
        return run

    def started(part: int | None) -> DataFrame:
        left = tables.read(found_at, found_schema, part).where("kind = 0").select(F.col("block").alias("part"), "doc_id", "held_out", "n", "keys")
        right = tables.read(known_at, known_schema, part).where("symbol IS NULL").select("block", "bucket", "n", "answer", "ranks")
        return left.groupBy("part").cogroup(right.groupBy("block")).applyInArrow(first, shape)

    def lengthened_by(level_at: str, answers_at: str, answers_schema, last: bool):
        def level(part: int | None) -> DataFrame:
            own = [F.col("block").alias("part"), *(c for c in level_schema.names if c not in ("block", "bucket", "below"))]
            left, right = tables.read(level_at, level_schema, part).select(*own), tables.read(answers_at, answers_schema, part)
            return left.groupBy("part").cogroup(right.groupBy("block")).applyInArrow(longer(last), shape)
        return level

    level, over, level_schema = started, [found_at, known_at], started(None).schema
    del found, known
    for k in range(1, depth + 1):
        level_at = new_run_dir(spark, f"contexts-{k}")
        for part in range(parts):
            tables.store(level(part), level_at)
            tables.drop(*(f"{x}/part={part}" for x in over))
        answers = settled_runs(tables.read(level_at, level_schema).where("kind = 1"), buckets, divergence, least_count, hot, k == depth)
        answers_at, answers_schema = stored(answers, f"answers-{k}"), answers.schema
        del answers
        tables.drop(*(f"{level_at}/part={part}/kind=1" for part in range(parts)))
        level, over = lengthened_by(level_at, answers_at, answers_schema, k == depth), [level_at, answers_at]
    return level(None).select("doc_id", "held_out", F.col("n").alias("n_tokens"), F.col("known").alias("n_known"),
                              F.lit(train_tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
