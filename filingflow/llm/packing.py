"""Best-fit packing of documents into fixed-length sequences, after a
Martello-Toth dominance reduction.

Documents become token pieces of at most ``capacity`` tokens. Packing needs
only how many pieces there are of each length, so the instance that the driver
solves has at most ``capacity`` rows however many documents there are:

1. ``reduce_by_dominance`` fixes, from the longest length down, sets of one,
   two or three pieces that provably dominate every other set with that piece
   (Martello and Toth's criterion), as many at once as the counts allow;
2. ``best_fit`` packs what is left, longest first, each into the fullest
   sequence with room;
3. the pieces are ranked within their length and take the places that the
   plan holds for that length.

Ranks come from a window over (length, one of ``RANK_BUCKETS`` hash buckets of
the id) plus the counts of the buckets before, so a length shared by a third
of all rows is spread over many tasks.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import blocks, give_back, prepare, ragged_take, stored, texts_of, words_of

RANK_BUCKETS = 256
#: words, and parts of words, remembered by a worker before it starts afresh
MEMO_WORDS = 200_000
#: text bytes handled at once: ids and their places take about 15 times that
IDS_BLOCK_BYTES = 3 << 20

_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of white-space separated words by a tokenizer that never merges
    across white space, remembered by word.

    A word of letters that are their own composed form, with an optional run
    of marks behind, goes to the BPE model directly, one part at a time; every
    other word goes through the whole tokenizer.
    """

    #: letters whose NFC form is themselves and whose lower case is one letter
    _plain = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-;=?-@\\[-`{}~]*)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # ids are remembered as packed 32-bit numbers
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.by_parts = self._agrees()

    def _whole(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _agrees(self) -> bool:
        """Whether the direct way gives the tokenizer's ids on words of every
        shape it is used for; if not, every word takes the whole tokenizer."""
        probe = ["the", "The", "Éauouon.", "schön,", "WORD!!", "ab%%%", "ça&&&", "x", "ÿß;", "ÀÖØ(", "a###"]
        return all(self._by_parts(w) == self._whole(w) for w in probe)

    def _by_parts(self, word: str) -> bytes | None:
        m = self._plain.fullmatch(word)
        if m is None:
            return None
        out = b""
        for part in m.groups():
            if part:
                ids = self.parts.get(part)
                if ids is None:
                    low = part.lower()
                    text = low if low.isascii() else low.encode().decode("latin-1").translate(_BYTE_LETTERS)
                    ids = self.parts[part] = array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
                out += ids
        return out

    def forget(self) -> None:
        """Drop what is remembered: the worker may turn to other work."""
        self.words, self.parts = {}, {}

    def encode(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word."""
        if len(self.words) > MEMO_WORDS:
            self.words = {}
        if len(self.parts) > MEMO_WORDS:
            self.parts = {}
        memo, found = self.words, []
        for w in words:
            ids = memo.get(w)
            if ids is None:
                ids = self._by_parts(w) if self.by_parts else None
                if ids is None:
                    ids = self._whole(w)
                memo[w] = ids
            found.append(ids)
        return found


def _byte_letters() -> dict[int, str]:
    """Letters that byte-level BPE writes for bytes: printable bytes stand for
    themselves, the others take the letters from U+0100 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in printable}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + i)
    return out


_BYTE_LETTERS = _byte_letters()


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def document_ids(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of a block of texts, each closed by ``end_id``: (ids, offsets)."""
    codes, words, offsets = words_of(texts, lower=False)
    per_word = encoder(path).encode(words.to_pylist())
    lengths = np.fromiter(map(len, per_word), np.int64, len(per_word)) // 4
    flat = np.frombuffer(b"".join(per_word), np.uint32)
    starts = np.cumsum(lengths) - lengths
    ids = ragged_take(flat, starts, lengths, codes)
    ends = np.concatenate([[0], np.cumsum(lengths[codes])])[offsets]
    sizes = np.diff(ends)
    out = np.full(len(ids) + len(sizes), end_id, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
    return out, np.concatenate([[0], np.cumsum(sizes + 1)])


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids
    (little-endian unsigned 32-bit ids as binary).

    Only a document longer than ``capacity`` is cut. A null or empty text is
    one piece holding the end id; a null id is kept; repeated rows each give
    their own pieces; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    path = tokenizer

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", IDS_BLOCK_BYTES):
            ids, offsets = document_ids(texts_of(block, "text"), path, end_id)
            sizes = np.diff(offsets)
            count = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(sizes[row] - start, capacity)
            begin = (offsets[row] + start).tolist()
            data = [ids[b:b + n].tobytes() for b, n in zip(begin, length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").combine_chunks().take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(data, pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids"])
        encoder(path).forget()
        give_back()

    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids binary")


class Plan:
    """Sequences to fill and, by length, the places held for its pieces.

    A *group* is a run of sequences filled alike. A place row
    (length, first rank, group's first sequence, pieces per sequence, offset)
    holds for the ranks up to the next row of that length.
    """

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.places: list[tuple[int, int, int, int, int]] = []
        self.used: dict[int, int] = {}

    def new_group(self, count: int) -> int:
        first = self.sequences
        self.sequences += count
        return first

    def put(self, length: int, first: int, count: int, per: int, offset: int, items: int | None = None) -> None:
        """Hold places for ``per`` pieces of ``length`` in each of ``count`` sequences."""
        rank = self.used.get(length, 0)
        self.places.append((length, rank, first, per, offset))
        self.used[length] = rank + (count * per if items is None else items)


def _largest(counts: np.ndarray, most: int) -> int:
    """The longest length up to ``most`` with pieces left, or 0."""
    there = np.flatnonzero(counts[1:most + 1]) if most > 0 else np.empty(0, np.int64)
    return int(there[-1]) + 1 if len(there) else 0


def _smallest(counts: np.ndarray, n: int) -> list[int]:
    """The ``n`` shortest pieces left (a length counts as often as it has pieces)."""
    out: list[int] = []
    for s in np.flatnonzero(counts)[:n].tolist():
        out += [s] * min(int(counts[s]), n - len(out))
        if len(out) == n:
            break
    return out


def _best_pair(counts: np.ndarray, room: int) -> int:
    """The largest sum up to ``room`` of two pieces that are left, or 0."""
    lengths = np.flatnonzero(counts[:room + 1])
    lo, hi, best = 0, len(lengths) - 1, 0
    while lo <= hi:
        total = int(lengths[lo] + lengths[hi])
        if total > room or lo == hi and counts[lengths[lo]] < 2:
            hi -= 1
        else:
            best = max(best, total)
            lo += 1
    return best


def dominating(counts: np.ndarray, longest: int, capacity: int) -> tuple[int, ...] | None:
    """Pieces to put with one piece of ``longest`` (itself already taken out of
    ``counts``) such that the set dominates every other set with that piece;
    None if that can't be shown."""
    room = capacity - longest
    small = _smallest(counts, 3)
    if not small or small[0] > room:
        return ()
    top = _largest(counts, room)
    if top == room:
        return (top,)
    if len(small) < 2 or small[0] + small[1] > room:
        return (top,)
    if len(small) == 3 and sum(small) <= room:
        return None
    # two more pieces fit, three never do
    if _best_pair(counts, room) <= top:
        return (top,)
    counts[top] -= 1
    second = _largest(counts, room - top)
    counts[top] += 1
    if second and _largest(counts, room // 2) <= second:
        return (top, second)
    return None


def reduce_by_dominance(counts: np.ndarray, plan: Plan) -> None:
    """Fix dominating sets, from the longest pieces down, until none is left
    to fix; takes them out of ``counts``."""
    changed = True
    while changed:
        changed = False
        for j in range(plan.capacity, 0, -1):
            while counts[j]:
                counts[j] -= 1
                others = dominating(counts, j, plan.capacity)
                counts[j] += 1
                if others is None:
                    break
                need = {j: 1}
                for s in others:
                    need[s] = need.get(s, 0) + 1
                # a set stays dominating while its own lengths last: taking
                # pieces away only removes alternatives
                q = min(int(counts[s]) // k for s, k in need.items()) if others else int(counts[j])
                first, offset = plan.new_group(q), 0
                for s in (j, *others):
                    plan.put(s, first, q, 1, offset)
                    offset += s
                    counts[s] -= q
                changed = True


def best_fit(counts: np.ndarray, plan: Plan) -> None:
    """Best-fit decreasing over lengths: a piece goes to the fullest sequence
    with room, so a run of equal pieces fills the sequences of one group one
    after the other."""
    cap = plan.capacity
    open_: dict[int, list[tuple[int, int]]] = {}  # room -> groups (first, count)
    rooms = np.zeros(cap + 1, bool)

    def push(room: int, first: int, count: int) -> None:
        if room and count:
            open_.setdefault(room, []).append((first, count))
            rooms[room] = True

    for s in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[s])
        while left:
            fit = np.flatnonzero(rooms[s:])
            if len(fit):
                room = s + int(fit[0])
                first, count = open_[room].pop()
                if not open_[room]:
                    rooms[room] = False
            else:
                room = cap
                count = -(-left // (cap // s))
                first = plan.new_group(count)
            per, offset = room // s, cap - room
            whole = min(count, left // per)
            if whole:
                plan.put(s, first, whole, per, offset)
                push(room - per * s, first, whole)
                left -= whole * per
            rest = count - whole
            if rest and left and left < per:
                plan.put(s, first + whole, 1, per, offset, left)
                push(room - left * s, first + whole, 1)
                whole, rest, left = whole + 1, rest - 1, 0
            push(room, first + whole, rest)
        counts[s] = 0


def pack_lengths(counts: dict[int, int], capacity: int) -> Plan:
    """The plan for ``counts`` pieces of each length."""
    left = np.zeros(capacity + 1, np.int64)
    for s, n in counts.items():
        left[s] = n
    plan = Plan(capacity)
    reduce_by_dominance(left, plan)
    best_fit(left, plan)
    return plan


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
         payload: dict[str, Column] | None = None) -> DataFrame:
    """Pack all documents: doc_id, piece, start, length, ids, sequence_id, offset.

    ``payload`` replaces the ``ids`` column by expressions over it, computed
    before the pieces are stored (a digest is narrower to shuffle than ids).
    Nulls, empty and repeated rows: see ``token_pieces``. An empty table gives
    an empty result.
    """
    spark = prepare(docs.sparkSession)
    keep = payload if payload is not None else {"ids": F.col("ids")}
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col)
                    .select("doc_id", "piece", "start", "length", *[c.alias(n) for n, c in keep.items()])
                    .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANK_BUCKETS)).cast("int")), "pieces")
    per_bucket = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    per_bucket = stored(per_bucket, "piece-counts")  # at most capacity x RANK_BUCKETS rows
    counts = {r["length"]: r["n"] for r in per_bucket.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = pack_lengths(counts, capacity)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    ranked = (pieces.withColumn("rank", F.row_number().over(inside) - 1)
              .join(F.broadcast(offsets), ["length", "bucket"])
              .withColumn("rank", F.col("rank") + F.col("before")).drop("before", "bucket"))
    places = np.array(sorted(plan.places), np.int64).reshape(-1, 5)
    names = ["doc_id", "piece", "start", "length", *keep]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (places[:, 0] << 44) + places[:, 1]
        for b in batches:
            length = b.column(b.schema.get_field_index("length")).to_numpy()
            rank = b.column(b.schema.get_field_index("rank")).to_numpy()
            p = places[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
            local = rank - p[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(b.schema.get_field_index(n)) for n in names],
                 pa.array(p[:, 2] + local // p[:, 3], pa.int64()), pa.array(p[:, 4] + local % p[:, 3] * length, pa.int64())],
                names=[*names, "sequence_id", "offset"])

    shape = ", ".join(f"`{n}` {pieces.schema[n].dataType.simpleString()}" for n in names)
    return ranked.select(*names, F.col("rank").cast("long").alias("rank")).mapInArrow(place, f"{shape}, sequence_id long, offset long")
