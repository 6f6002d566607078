"""Encoding and decoding with a merge-type (BPE) sentencepiece vocabulary.

Encoding keeps an *agenda* of adjacent symbol pairs, best score first and
leftmost among equals: the best pair whose concatenation is in the vocabulary
is merged, and the pairs that the new symbol forms with its neighbours join
the agenda. A symbol that stays outside the vocabulary falls back to bytes.

A blank is the mark U+2581. No piece has that mark behind another character,
so no merge crosses from a chunk (a run of marks and the characters behind it)
to the next; the vocabulary is checked for this when it is loaded. Chunks are
therefore encoded one by one, each distinct chunk of a block once, and
remembered. Every chunk that a worker meets for the first time is also encoded
by the sentencepiece library, in Arrow batches, and a difference is an error.
Decoding is the library's ``decode``.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, interned, prepare, ragged_take, texts_of

MARK = "▁"
#: chunks remembered by a worker before it starts afresh
MEMO_CHUNKS = 500_000
#: up to so many characters a chunk's agenda is a plain list
SHORT_CHUNK = 48
#: text bytes handled at once: ids and their places take about 15 times that
IDS_BLOCK_BYTES = 6 << 20

_CODECS: dict[str, PieceCodec] = {}


class PieceCodec:
    """A vocabulary with its scores, the library's processor, and the chunks met."""

    _chunk = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def __init__(self, path: str):
        import sentencepiece
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a blank behind another character; chunks can't be encoded one by one")
        if any(sp.is_unused(i) for i in plain):
            raise ValueError("vocabularies with unused pieces aren't supported")
        self.ranks = {p: (-sp.get_score(i)) for p, i in self.ids.items()}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.memo: dict[str, bytes] = {}  # ids as packed 32-bit numbers

    def merge(self, chunk: str) -> tuple[int, ...]:
        """Ids of one chunk (blanks as marks), by the agenda. For a chunk of few
        characters the agenda is a list that is searched for its best pair."""
        whole = list(chunk)
        if len(whole) > SHORT_CHUNK:
            return self._ids(self._merged(whole))
        get, none = self.ranks.get, math.inf
        agenda = [get(p, none) for p in map(add, whole, whole[1:])]
        while agenda and (best := min(agenda)) != none:
            i = agenda.index(best)
            del agenda[i]
            piece = whole[i] + whole.pop(i + 1)
            whole[i] = piece
            if i < len(agenda):
                agenda[i] = get(piece + whole[i + 1], none)
            if i:
                agenda[i - 1] = get(whole[i - 1] + piece, none)
        return self._ids(whole)

    def _merged(self, whole: list[str]) -> list[str]:
        """The symbols of a long chunk after all merges ('' where one was merged away)."""
        n = len(whole)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks = self.ranks
        agenda = [(ranks[p], i, p) for i, p in enumerate(map("".join, zip(whole, whole[1:]))) if p in ranks]
        heapq.heapify(agenda)
        while agenda:
            _, i, piece = heapq.heappop(agenda)
            left = whole[i]
            j = after[i]
            # the pair is void once either of its symbols has been merged away
            if not left or j >= n or len(left) + len(whole[j]) != len(piece) or left + whole[j] != piece:
                continue
            whole[i], whole[j] = piece, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                p = piece + whole[k]
                if p in ranks:
                    heapq.heappush(agenda, (ranks[p], i, p))
            h = before[i]
            if h >= 0:
                p = whole[h] + piece
                if p in ranks:
                    heapq.heappush(agenda, (ranks[p], h, p))
        return whole

    def _ids(self, symbols: list[str]) -> tuple[int, ...]:
        ids = self.ids
        out: list[int] = []
        for s in symbols:
            if s:
                known = ids.get(s)
                if known is None:
                    out.extend(self.bytes[b] for b in s.encode())
                else:
                    out.append(known)
        return tuple(out)

    def chunks_of(self, text: str) -> list[str]:
        """Chunks of a whole text: one blank in front, blanks as marks."""
        return self._chunk.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of chunks. Each new one is checked against the library, which
        puts a blank in front itself."""
        if len(self.memo) > MEMO_CHUNKS:
            self.memo = {}
        memo = self.memo
        new = [c for c in dict.fromkeys(chunks) if c not in memo]
        if new:
            mine = [self.merge(c) for c in new]
            theirs = self.library.encode([c[1:] for c in new], num_threads=1)
            for c, a, b in zip(new, mine, theirs):
                # of a lone blank the library makes nothing: it stands inside a text only
                if list(a) != b and c != MARK:
                    raise ValueError(f"the agenda and the library differ on {c!r}: {a} and {b}")
                memo[c] = array("i", a).tobytes()
        return [memo[c] for c in chunks]

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets)."""
        lists = pc.split_pattern(texts, " ")
        odd = pc.or_(pc.match_substring(texts, MARK),
                     pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " "))))
        odd = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        codes, words, offsets = interned(lists)
        chunks = [MARK + w for w in words.to_pylist()]
        extra: dict[str, int] = {}
        if len(odd):
            # texts with runs of blanks, blanks at an end or marks of their own
            parts = [codes]
            spans: list[tuple[int, int]] = []
            at = len(codes)
            for i in odd.tolist():
                own = [extra.setdefault(c, len(chunks) + len(extra)) for c in self.chunks_of(texts[i].as_py())]
                parts.append(np.array(own, np.int64))
                spans.append((at, at + len(own)))
                at += len(own)
            codes = np.concatenate(parts)
            starts, stops = offsets[:-1].copy(), offsets[1:].copy()
            starts[odd], stops[odd] = [a for a, _ in spans], [b for _, b in spans]
        else:
            starts, stops = offsets[:-1], offsets[1:]
        per_chunk = self.encode([*chunks, *extra])
        lengths = np.fromiter(map(len, per_chunk), np.int64, len(per_chunk)) // 4
        flat = np.frombuffer(b"".join(per_chunk), np.int32)
        if len(odd):
            codes = ragged_take(codes, starts, stops - starts, np.arange(len(starts)))
            counts = stops - starts
            offsets = np.concatenate([[0], np.cumsum(counts)])
        ids = ragged_take(flat, np.cumsum(lengths) - lengths, lengths, codes)
        return ids, np.concatenate([[0], np.cumsum(lengths[codes])])[offsets]


def codec(path: str) -> PieceCodec:
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def encode_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (array<int>), decoded (string).

    A null or empty text has no ids and decodes to the empty string; a null id
    is kept; repeated rows give repeated results; an empty table gives an
    empty result; other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for block in blocks(batches, "text", IDS_BLOCK_BYTES):
            ids, offsets = c.encode_texts(texts_of(block, "text"))
            listed, ends = ids.tolist(), offsets.tolist()
            decoded = c.library.decode([listed[a:b] for a, b in zip(ends, ends[1:])], num_threads=1)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").combine_chunks(), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                 pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
