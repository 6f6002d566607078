"""Jaccard self-join on word shingles by universe partition and pigeonhole.

A document's set holds the 64-bit hashes of its distinct shingles. Two sets
with Jaccard similarity of at least ``percent``/100 differ in at most H
elements, H following from their sizes. Sets are dealt into *size bands*, each
at most 100/percent times as high as low, so a set can only link inside its
band or with a neighbouring one; it takes part in the scheme of its own band
(with sets as large or larger) and in that of the band below.

Scheme b hashes the universe into H+1 segments. If two sets differ in at most
H elements then they agree in some segment (pigeonhole), so each set indexes a
key per segment. Agreement on an *empty* segment says nothing and would meet
everybody, so the allocation moves its share elsewhere: the first t segments
of a scheme also index their one-deletion neighbourhoods, which makes each of
them worth two differences instead of one and leaves t to spare for empty
segments. t is the least number that, at the expected segment size, covers the
empty segments of nearly every set (``allocation``); the few sets with more
(*poor* sets) index their empty segments too, under keys that only poor sets
have. A pair is missed by neither way: unless both sets are poor, one of them
has shares enough on segments that both index.

Buckets of equal keys give candidates. A bucket's members meet in tiles of
bounded size, where they are compared by *parity bitmaps*: an element flips one
bit, so two bitmaps differ in at most as many bits as the sets in elements,
and a pair whose bitmaps differ in more bits than the sets may is none. Of the
pairs that pass, a tile gives a spanning forest only; these are compared whole
and merged into components. A second round gives all passing pairs between
different components, so no link between components is missed although most
pairs inside one are never formed. Sets that are equal are one class from the
start.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, hashes_of, mix64, prepare, stored, texts_of, words_of
from .graph import components, hinted

#: members of a tile's side
TILE = 1024
#: text bytes handled at once: sets, keys and their lists take many times that
SETS_BLOCK_BYTES = 2 << 20


def _widest(low_sum: int, high_sum: int, percent: int) -> int:
    """The most elements in which two sets of these total sizes may differ."""
    return max(s - 2 * -(-percent * s // (100 + percent)) for s in range(max(low_sum, high_sum - 2 * (100 + percent)), high_sum + 1))


def allocation(segments: int, low: int) -> int:
    """How many segments index deletions, for sets of ``low`` elements or more."""
    if segments <= 3:
        return segments
    mean = low / segments
    none, one = math.exp(-mean), mean * math.exp(-mean)
    for t in range(1, segments):
        need = (segments - t) * none + t * (2 * none + one)
        if t >= need + 4 * math.sqrt(need):
            return t
    return segments


@lru_cache(maxsize=None)
def schemes(percent: int, largest: int) -> list[tuple[int, int, int, int]]:
    """Per size band: (low, high, segments, segments with deletions); no
    segments where only equal sets can link."""
    out, low = [], 1
    while low <= largest:
        high = max(low, low * 100 // percent)
        differ = _widest(2 * low, high + high * 100 // percent, percent)
        segments = differ + 1 if differ > 0 else 0
        out.append((low, high, segments, allocation(segments, low) if segments else 0))
        low = high + 1
    return out


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text. A text of fewer than
    ``n`` words is one shingle; one without words is the empty set."""
    codes, words, offsets = words_of(texts)
    word = hashes_of(words)[codes] if len(codes) else np.empty(0, np.uint64)
    rolled = np.zeros(max(0, len(word) - n + 1), np.uint64)
    for k in range(n):
        rolled = mix64(rolled + word[k:k + len(rolled)] + np.uint64(k))
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(rolled[a:b - n + 1]))
        elif b > a:
            h = np.array([b - a], np.uint64)
            for k in range(a, b):
                h = mix64(h * np.uint64(31) + word[k:k + 1])
            out.append(h)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _scheme_keys(s: np.ndarray, band: int, segments: int, deleting: int) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of a set in one scheme: (of segments, of deletions)."""
    own = mix64(s ^ mix64(np.array([band + 1], np.uint64)))
    at = ((own >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    order = np.argsort(at, kind="stable")
    at, weight = at[order].astype(np.int64), mix64(own + np.uint64(0x632BE59B))[order]
    count = np.bincount(at, minlength=segments)
    ends = np.cumsum(count)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weight)])
    sums = total[ends] - total[ends - count]
    salt = mix64(np.arange(segments, dtype=np.uint64) + np.uint64((band + 1) << 32))
    full = count > 0
    keys = mix64(sums + salt)[full]
    head = at < deleting
    several = head & (count[at] > 1)
    cut = mix64((sums[at[several]] - weight[several]) + salt[at[several]])
    # shares missing: an empty segment lacks its worth, a single element its deletion
    short = int((~full).sum() + (~full[:deleting]).sum() + (count[:deleting] == 1).sum())
    if segments + deleting - short < segments:
        poor = mix64(salt + np.uint64(0x5851F42D))
        keys = np.concatenate([keys, poor[~full]])
        single = np.flatnonzero(count[:deleting] == 1)
        cut = np.concatenate([cut, poor[single]])
    return keys, cut


def index_keys(s: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All index keys of a set, over the schemes that it takes part in."""
    plan = schemes(percent, 1 << max(10, len(s).bit_length()))
    lows = [x[0] for x in plan]
    own = int(np.searchsorted(lows, len(s), side="right")) - 1
    found = [_scheme_keys(s, b, plan[b][2], plan[b][3]) for b in (own - 1, own) if b >= 0 and plan[b][2] and len(s) <= plan[b][1] * 100 // percent]
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.unique(np.concatenate([k for k, _ in found])), np.unique(np.concatenate([c for _, c in found]))


def parity_bitmap(s: np.ndarray) -> bytes:
    """Parities of the set's elements by hash: 512 to 4096 bits, about two per
    element. Folding a bitmap in half gives that of half as many bits."""
    bits = min(4096, max(512, 1 << (2 * len(s) - 1).bit_length()))
    odd = np.bincount((mix64(s + np.uint64(0x1F83D9AB)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, folded to the shortest one's length."""
    least = min(map(len, bitmaps))
    out = np.empty((len(bitmaps), least // 8), np.uint64)
    for i, b in enumerate(bitmaps):
        x = np.frombuffer(b, np.uint64)
        while len(x) * 8 > least:
            x = x[:len(x) // 2] ^ x[len(x) // 2:]
        out[i] = x
    return out


def tile_pairs(nodes: np.ndarray, sizes: np.ndarray, whole: np.ndarray, bitmaps: list[bytes], percent: int, labels: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile that may link: all of different ``labels``, or, without
    labels, a spanning forest of them."""
    n = len(nodes)
    words = _folded(bitmaps)
    may = np.zeros((n, n), bool)
    for i in range(n):
        total = sizes[i] + sizes
        most = total - 2 * -(-percent * total // (100 + percent))
        may[i] = np.bitwise_count(words ^ words[i]).sum(axis=1, dtype=np.int64) <= most
    may &= (whole[:, None] | whole[None, :]) & (nodes[:, None] != nodes[None, :])
    if labels is not None:
        x, y = np.nonzero(may & (labels[:, None] != labels[None, :]) & (nodes[:, None] < nodes[None, :]))
        return nodes[x], nodes[y]
    seen, left, right = np.zeros(n, bool), [], []
    for start in np.argsort(-may.sum(axis=1), kind="stable"):
        if seen[start]:
            continue
        seen[start] = True
        front = [start]
        while front:
            i = front.pop(0)
            new = np.flatnonzero(may[i] & ~seen)
            seen[new] = True
            left += [i] * len(new)
            right += new.tolist()
            front += new.tolist()
    x, y = nodes[np.array(left, np.int64)], nodes[np.array(right, np.int64)]
    return np.minimum(x, y), np.maximum(x, y)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(flat))


def signatures(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, size, f1, f2 (128-bit fingerprint of the set), bitmap, keys, cuts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", SETS_BLOCK_BYTES):
            sets = shingle_sets(texts_of(block, "text"), n)
            prints = [(int(mix64(s).sum(dtype=np.uint64)), int(mix64(s ^ np.uint64(0x2545F491)).sum(dtype=np.uint64))) for s in sets]
            both = [index_keys(s, percent) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").combine_chunks(), pa.array([len(s) for s in sets], pa.int64()),
                 *[pa.array(np.array([p[i] for p in prints], np.uint64).view(np.int64)) for i in (0, 1)],
                 pa.array([parity_bitmap(s) for s in sets], pa.binary()), _lists([k for k, _ in both]), _lists([c for _, c in both])],
                names=["doc_id", "size", "f1", "f2", "bitmap", "keys", "cuts"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, size long, f1 long, f2 long, bitmap binary, keys array<long>, cuts array<long>")


def whole_sets(rows: DataFrame, n: int) -> DataFrame:
    """node, elements: the sets of the given documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", SETS_BLOCK_BYTES):
            yield pa.RecordBatch.from_arrays([block.column("doc_id").combine_chunks(), _lists(shingle_sets(texts_of(block, "text"), n))], names=["node", "elements"])

    return rows.mapInArrow(run, f"node {rows.schema['doc_id'].dataType.simpleString()}, elements array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold, compared whole."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("elements").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("a", "b")


def _candidates(held: DataFrame, percent: int, labelled: bool) -> DataFrame:
    """Pairs (a, b) from the tiles of all buckets. A bucket of n members is cut
    into slices of about TILE; each two slices, and each with itself, are a tile."""
    slices = F.greatest(F.lit(1), F.ceil(F.col("n") / TILE).cast("int"))
    mine = F.pmod(F.xxhash64("node"), slices).cast("int")
    tiles = held.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), slices - 1)))
    tiles = tiles.withColumn("tile", F.least("mine", "other") * F.lit(1 << 32) + F.greatest("mine", "other")).drop("mine", "other", "n")
    kind = held.schema["node"].dataType.simpleString()

    def found(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return tile_pairs(t.column("node").to_numpy(), t.column("size").to_numpy(), t.column("whole").to_numpy(),
                          t.column("bitmap").to_pylist(), percent, t.column("label").to_numpy() if labelled else None)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted, so a tile is a run of rows; the last run of a batch
        # may go on in the next one
        rest: pa.Table | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                if rest is None:
                    return
                t, last = rest, True
            else:
                own = pa.Table.from_batches([batch])
                t, last = (own if rest is None else pa.concat_tables([rest, own])).combine_chunks(), False
            key, tile = t.column("key").to_numpy(), t.column("tile").to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (tile[1:] != tile[:-1])) + 1
            cuts = [0, *cuts.tolist(), *([len(key)] if last else [])]
            got = [found(t.slice(x, y - x)) for x, y in zip(cuts, cuts[1:])]
            rest = t.slice(cuts[-1])
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([g[i] for g in got]), at) for i in (0, 1)], names=["a", "b"])

    at = pa.int64() if kind == "bigint" else None
    tiles = tiles.repartition("key", "tile").sortWithinPartitions("key", "tile")
    return tiles.mapInArrow(pairs, f"a {kind}, b {kind}").distinct()


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id that a document is
    linked with, directly or through others, itself included), one row per
    input row.

    Null and empty texts, and texts of white space, have the empty set and
    link with nothing. Rows with a null id link with nothing and have a null
    component. Rows that repeat id and text share their result; different
    texts under one id count as linked through that id. An empty table gives
    an empty result; other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = stored(signatures(rows, n, percent), "shingle-signatures")
    linkable = signed.where("size > 0 AND doc_id IS NOT NULL")
    face = ["size", "f1", "f2"]
    classes = (linkable.groupBy(*face).agg(F.min("doc_id").alias("node"), F.max("doc_id").alias("last"))
               .where("node < last").select(*face, "node"))
    classes = stored(classes, "equal-sets")
    members = linkable.select("doc_id", *face).join(classes, face).where("doc_id <> node")
    copies = stored(members.select("doc_id", "f1").distinct(), "copies")
    nodes = linkable.join(hinted(copies), ["doc_id", "f1"], "left_anti")
    keyed = (nodes.select(F.col("doc_id").alias("node"), F.explode("keys").alias("key"), F.lit(True).alias("whole"))
             .union(nodes.select("doc_id", F.explode("cuts"), F.lit(False))))
    # most keys stand alone: counting first keeps the shuffled rows narrow
    shared = stored(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "keys-twice")
    keyed = stored(keyed.join(hinted(shared), "key"), "shared-key-rows")
    bucket = stored(_buckets(keyed, "node"), "shared-keys")
    # a bucket of two is a pair as it stands; larger ones go through tiles
    two = bucket.where("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    held = keyed.join(hinted(stored(bucket.where("n > 2").select("key", "n"), "larger-keys")), "key")
    faces = nodes.select(F.col("doc_id").alias("node"), "size", "bitmap")
    held = stored(held.join(faces, "node"), "bucket-members")
    links, labels = None, None
    for again in (False, True):
        if again:
            # only what different components share
            held = held.drop("n")
            held = held.withColumn("label", F.col("node")) if labels is None else \
                held.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            mixed = stored(_buckets(held, "label").select("key", "n"), "shared-keys")
            held = held.join(hinted(mixed), "key")
        pairs = _candidates(held, percent, again)
        pairs = stored(pairs if again else pairs.union(two).distinct(), "candidates")
        if pairs.isEmpty():
            break
        wanted = stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "candidate-nodes")
        sets = stored(whole_sets(rows.join(hinted(wanted), "doc_id", "left_semi"), n), "candidate-sets")
        new = stored(_verified(pairs, sets, percent), "verified")
        if new.isEmpty():
            continue
        links = new if links is None else links.union(new)
        labels = stored(components(links), "components")

    component = classes.select(*face, F.col("node").alias("known"))
    out = signed.select("doc_id", *face).join(component, face, "left").withColumn("node", F.coalesce("known", "doc_id"))
    if labels is not None:
        out = out.join(labels, "node", "left")
    else:
        out = out.withColumn("label", F.lit(None).cast(signed.schema["doc_id"].dataType))
    mine = F.when(F.col("doc_id").isNotNull(), F.when(F.col("size") > 0, F.coalesce("label", "node")).otherwise(F.col("doc_id")))
    return out.select("doc_id", F.col("size").alias("n_shingles"), mine.alias("component_id"))


def _buckets(keyed: DataFrame, by: str) -> DataFrame:
    """(key, lo, hi, n) of the keys that more than one ``by`` has, at least
    one of them for a whole segment; n: how many rows have the key."""
    out = keyed.groupBy("key").agg(F.min(by).alias("lo"), F.max(by).alias("hi"), F.max("whole").alias("any"), F.count("*").alias("n"))
    return out.where("lo <> hi AND any").select("key", "lo", "hi", "n")
