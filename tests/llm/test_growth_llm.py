"""Figures of the text operators that must not grow: memory of a block, work per chunk."""

from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
from pyspark.sql import types as T

from filingflow.llm.ngram_join import signatures
from filingflow.llm.sentencepiece_bpe import MARK, SHORT_CHUNK, codec


def test_sets_are_made_in_small_blocks():
    """pipeline: blocks of 8 MB of text, with their sets, keys and lists, in every worker."""
    got = []

    class Rows:
        schema = {"doc_id": type("Field", (), {"dataType": T.LongType()})}

        def mapInArrow(self, run, shape):  # noqa: N802
            text = " ".join(f"w{i}" for i in range(1000))
            batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1000)), "text": [text] * 1000})
            got.extend(b.num_rows for b in run(iter([batch])))

    signatures(Rows(), 5, 80)
    assert sum(got) == 1000 and max(got) <= 500


def test_short_chunks_merge_as_long_ones_do():
    """op9: the agenda of a short chunk is a list; the heap gives the same pieces."""
    c = codec(public_tokenizers.path("piece_bpe_32k.model"))
    rnd = random.Random(5)
    for n in [1, 2, 3, SHORT_CHUNK - 1, SHORT_CHUNK, SHORT_CHUNK + 1, *(rnd.randrange(1, 60) for _ in range(500))]:
        chunk = MARK + "".join(rnd.choice("aaabetsn\u00e9\u20ac\U0001f600") for _ in range(n))
        assert c.merge(chunk) == c._ids(c._merged(list(chunk))) and list(c.merge(chunk)) == c.library.encode(chunk[1:])
