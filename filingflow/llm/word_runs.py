"""Periodic runs of words, found on a harmonic grid with difference-cover LCEs.

A run of period q and at least exponent * q words holds a stretch of
``step(q)`` = max(least, exponent * q) - q consecutive words that equal the
word q further on. Grid points ``step(q)`` apart for every q (n log n of them
in a text of n words) therefore touch every run. At a point whose words agree,
and go on agreeing to one side, the longest common extensions (LCE) to the
right and, on the reversed words, to the left give the run.

An LCE compares a few words until both places lie in a difference cover modulo
``COVER_MODULUS``: only suffixes at cover places are sorted (by their first
words, then by prefix doubling along the cover, since a place plus the modulus
is one too), and a sparse table over the common prefixes of neighbours in that
order answers the rest as a range minimum. Suffixes are sorted for texts that
have such a point; all others have no run.

Work is by block of texts in numpy; texts never meet, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, interned, one_array, prepare, texts_of

BLOCK = 4 << 20
#: Fixed value: a perfect difference set; every difference modulo 31 occurs once
COVER_MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
#: words compared at a grid point before its text is considered for sorting
GLANCE = 6
#: grid points held at once
POINTS = 2 << 20


def _shifts() -> np.ndarray:
    """shifts[i % v, j % v]: least s with i + s and j + s both in the cover."""
    v = COVER_MODULUS
    out = np.full((v, v), v, np.int64)
    for i in range(v):
        for j in range(v):
            out[i, j] = min(s for s in range(v) if (i + s) % v in COVER and (j + s) % v in COVER)
    return out


SHIFTS = _shifts()


class CoverLCE:
    """Longest common extensions inside segments of words.

    ``words`` holds the segments one after the other, each word > 0, a 0 after
    every segment. Queries are pairs i < j of one segment.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        v = COVER_MODULUS
        self.words = words
        segment = np.repeat(np.arange(len(starts)), lengths + 1)
        end = np.repeat(starts + lengths, lengths + 1)
        self.sampled = np.isin(np.arange(len(words)) % v, COVER) & (words > 0)
        self.at = np.flatnonzero(self.sampled)
        self.index = np.full(len(words), -1, np.int64)
        self.index[self.at] = np.arange(len(self.at))
        ends = end[self.at]
        self.levels = [self._by_first_words(segment[self.at], ends)]
        reach = v
        while len(self.at) and self.levels[-1].max() + 1 < len(self.at):
            rank = self.levels[-1]
            onward = self.at + reach
            inside = onward < ends
            second = np.where(inside, rank[self.index[np.where(inside, onward, 0)]] + 1, 0)
            self.levels.append(np.unique(rank * (len(self.at) + 1) + second, return_inverse=True)[1].astype(np.int64))
            reach *= 2
        self.rank = self.levels[-1]
        self.tables = self._minima(self._neighbours(ends))

    def _by_first_words(self, segment: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ranks by segment and the first words (0 beyond the end), as many
        words to a sort key as fit."""
        if not len(self.at):
            return np.empty(0, np.int64)
        bits = max(1, int(self.words.max()).bit_length())
        per = 63 // bits
        keys = [segment]
        for first in range(0, COVER_MODULUS, per):
            key = np.zeros(len(self.at), np.int64)
            for t in range(first, min(first + per, COVER_MODULUS)):
                place = self.at + t
                key = (key << bits) | np.where(place < ends, self.words[np.minimum(place, len(self.words) - 1)], 0)
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        for key in keys:
            k = key[order]
            new[1:] |= k[1:] != k[:-1]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _neighbours(self, ends: np.ndarray) -> np.ndarray:
        """Common prefixes of suffixes next to each other in rank order. Two
        places of a segment that share a rank agree on all of its words."""
        order = np.empty(len(self.at), np.int64)
        order[self.rank] = np.arange(len(self.at))
        a, b = self.at[order[:-1]], self.at[order[1:]]
        end_a, end_b = ends[order[:-1]], ends[order[1:]]
        common = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, reach = self.levels[k], COVER_MODULUS << k
            open_ = np.flatnonzero((a + common < end_a) & (b + common < end_b))
            same = level[self.index[a[open_] + common[open_]]] == level[self.index[b[open_] + common[open_]]]
            common[open_[same]] += reach
        live = np.flatnonzero(end_a == end_b)
        common[end_a != end_b] = 0
        for _ in range(COVER_MODULUS):
            x, y = a[live] + common[live], b[live] + common[live]
            same = (self.words[x] == self.words[y]) & (self.words[x] > 0)
            live = live[same]
            if not len(live):
                break
            common[live] += 1
        return common

    @staticmethod
    def _minima(values: np.ndarray) -> list[np.ndarray]:
        tables = [values.astype(np.int32 if len(values) == 0 or values.max() < 2 ** 31 else np.int64)]
        width = 1
        while 2 * width <= len(values):
            last = tables[-1]
            tables.append(np.minimum(last[:-width], last[width:]))
            width *= 2
        return tables

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of the neighbours' common prefixes over [lo, hi), lo < hi."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.tables[k][lo[at]], self.tables[k][hi[at] - (1 << int(k))])
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        shift = SHIFTS[i % COVER_MODULUS, j % COVER_MODULUS]
        out = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        met = np.zeros(len(i), bool)
        for t in range(COVER_MODULUS):
            there = shift[live] == t
            met[live[there]] = True
            live = live[~there]
            live = live[self.words[i[live] + t] == self.words[j[live] + t]]
            if not len(live):
                break
            out[live] += 1
        # the later place of a pair may have met the end of its segment
        met = np.flatnonzero(met)
        met = met[self.words[j[met] + out[met]] > 0]
        a = self.rank[self.index[i[met] + out[met]]]
        b = self.rank[self.index[j[met] + out[met]]]
        out[met] += self.least(np.minimum(a, b), np.maximum(a, b))
        return out


def looped(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """``words`` with the tails of texts whose seed is a multiple of ten made
    periodic: with g = seed // 10, words from a = g % n on repeat the p =
    1 + (n - a) // (3 + g % 8) words at a. Negative seeds change nothing."""
    out = words.copy()
    for k in np.flatnonzero((seeds >= 0) & (seeds % 10 == 0) & (lengths > 0)):
        n, g = int(lengths[k]), int(seeds[k]) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        lo = int(starts[k]) + a
        out[lo:lo + n - a] = words[lo + np.arange(n - a) % p]
    return out


class Runs:
    """Runs of the texts of a block."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, least: int, exponent: int):
        self.words, self.starts, self.lengths, self.min_words, self.exponent = words, starts, lengths, least, exponent
        self._docs, self._lce = np.empty(0, np.int64), None
        self._forward = self._backward = np.empty(0, np.int64)

    def step(self, q: np.ndarray) -> np.ndarray:
        return np.maximum(self.min_words, self.exponent * q) - q

    def grid(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, period, place) of the grid points, ``POINTS`` or so at once."""
        periods = np.where(self.lengths >= self.min_words, self.lengths // self.exponent, 0)
        before = np.cumsum(periods) - periods
        total = int(periods.sum())
        at = 0
        while at < total:
            pair = np.arange(at, min(at + POINTS // 4, total))
            doc = np.searchsorted(before, pair, side="right") - 1
            # texts without a period share their "before" with the next one
            q = pair - before[doc] + 1
            step = self.step(q)
            points = np.maximum(0, self.lengths[doc] - q) // step
            ends = np.cumsum(points)
            take = max(1, int(np.searchsorted(ends, POINTS, side="right")))
            doc, q, step, points = doc[:take], q[:take], step[:take], points[:take]
            k = np.arange(int(points.sum())) - np.repeat(np.cumsum(points) - points, points)
            yield np.repeat(doc, points), np.repeat(q, points), np.repeat(step, points) * (k + 1) - 1
            at += take

    def glance(self, doc: np.ndarray, q: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Points that may lie on a run: the words agree there and over half of
        the stretch (``GLANCE`` words of it are looked at) to one side."""
        base, w = self.starts[doc] + g, self.words
        hit = np.flatnonzero(w[base] == w[base + q])
        base, q, half = base[hit], q[hit], self.step(q[hit]) // 2 + 1
        out = np.zeros(len(hit), bool)
        for sign in (1, -1):
            live = np.arange(len(hit))
            for t in range(1, GLANCE):
                more = live[half[live] > t]
                out[live[half[live] <= t]] = True
                x, y = base[more] + sign * t, base[more] + q[more] + sign * t
                # a 0 stands before and after every text
                live = more[(w[x] == w[y]) & (w[x] > 0) & (w[y] > 0)]
            out[live] = True
        return hit[out]

    def prepare(self, docs: np.ndarray) -> None:
        """Sorted suffixes of the words, and of the reversed words, of ``docs``."""
        if self._lce is not None and np.isin(docs, self._docs).all():
            return
        n = self.lengths[docs]
        both = np.repeat(n, 2)
        starts = np.cumsum(both + 1) - (both + 1)
        words = np.zeros(int(both.sum()) + len(both), np.int64)
        for k, d in enumerate(docs.tolist()):
            text = self.words[self.starts[d]:self.starts[d] + n[k]]
            words[starts[2 * k]:starts[2 * k] + n[k]] = text
            words[starts[2 * k + 1]:starts[2 * k + 1] + n[k]] = text[::-1]
        self._docs, self._lce = docs, CoverLCE(words, starts, both)
        self._forward, self._backward = starts[::2], starts[1::2]

    def find(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, length, period) of all runs, by text, start, period."""
        found = [np.empty((4, 0), np.int64)]
        for doc, q, g in self.grid():
            at = self.glance(doc, q, g)
            if not len(at):
                continue
            doc, q, g = doc[at], q[at], g[at]
            self.prepare(np.unique(doc))
            k = np.searchsorted(self._docs, doc)
            right = self._lce.lce(self._forward[k] + g, self._forward[k] + g + q)
            mirror = self._backward[k] + self.lengths[doc] - 1 - g
            left = self._lce.lce(mirror - q, mirror)
            equal = left + right - 1
            ok = equal >= self.step(q)
            run = np.stack([doc, g - left + 1, equal + q, q])[:, ok]
            # a stretch is found with multiples of its period too
            found.append(self.smallest(run))
        return tuple(self.smallest(np.concatenate(found, axis=1)))

    @staticmethod
    def smallest(run: np.ndarray) -> np.ndarray:
        """Each stretch once, with its smallest period."""
        run = run[:, np.lexsort((run[3], run[2], run[1], run[0]))]
        first = np.ones(run.shape[1], bool)
        first[1:] = (run[:3, 1:] != run[:3, :-1]).any(axis=0)
        run = run[:, first]
        return run[:, np.lexsort((run[3], run[1], run[0]))]


def block_runs(texts: pa.Array, seeds: np.ndarray, least: int, exponent: int) -> tuple[pa.Array, pa.Array]:
    """(runs, texts without repeated periods) of a block of texts."""
    codes, distinct, offsets = interned(pc.ascii_split_whitespace(texts))
    lengths = np.diff(offsets)
    # a 0 before the first text and after every one
    starts = offsets[:-1] + np.arange(len(lengths)) + 1
    words = np.zeros(len(codes) + len(lengths) + 1, np.int64)
    place = np.arange(len(codes)) + np.repeat(np.arange(len(lengths)), lengths) + 1
    words[place] = codes + 1
    words = looped(words, starts, lengths, seeds)
    doc, start, length, period = Runs(words, starts, lengths, least, exponent).find()
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts[doc] + start + period, 1)
    np.add.at(change, starts[doc] + start + length, -1)
    kept = np.cumsum(change)[place] == 0
    ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
    left = distinct.take(pa.array(words[place][kept] - 1)) if len(codes) else pa.array([], pa.string())
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), left.cast(pa.string())), " ")
    per_doc = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(lengths)))])
    each = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], names=["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), each), collapsed


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def word_runs(docs: DataFrame, least: int = 6, exponent: int = 4, id_col: str = "doc_id", text_col: str = "text",
              loop: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, runs (by start, then period), collapsed.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of
    at least max(least, exponent * q) words with smallest period q that can't
    be extended; exponent is 2 or more. ``collapsed`` is the text's words
    joined by one space, without those that some run holds after its first q.
    ``loop`` (long) makes tails periodic first, see ``looped``.

    A null or empty text has no runs and collapses to the empty string; a null
    id is kept; repeated rows give repeated results; an empty table gives an
    empty result; other columns are ignored.
    """
    if exponent < 2 or least < 1:
        raise ValueError("exponent must be 2 or more, least 1 or more")
    prepare(docs.sparkSession)
    seed = F.coalesce((F.lit(None) if loop is None else loop).cast("bigint"), F.lit(-1))
    rows = docs.select(F.col(id_col).alias("doc_id"), seed.alias("seed"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK):
            runs, collapsed = block_runs(texts_of(block, "text"), one_array(block.column("seed")).to_numpy(zero_copy_only=False), least, exponent)
            yield pa.RecordBatch.from_arrays([one_array(block.column("doc_id")), runs, collapsed], names=["doc_id", "runs", "collapsed"])

    return rows.mapInArrow(run, f"doc_id {kind}, runs {RUNS}, collapsed string")
