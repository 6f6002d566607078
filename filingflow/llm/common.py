"""Helpers shared by the operators of this subpackage.

Texts reach Python in Arrow batches. A *block* is a run of rows holding about
``BLOCK_BYTES`` of text, so a worker's memory follows the block, not the
partition. Words of a block are interned once (Arrow dictionary encoding) and
work is done per distinct word wherever the method allows it.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_conf, stored

#: text bytes that a worker handles at once
BLOCK_BYTES = 16 << 20
#: rows and bytes that the JVM hands to Python at once
ARROW_ROWS, ARROW_BYTES = 2000, 32 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the library, and Arrow batches of bounded size."""
    ensure_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n`` (-1 for a null id)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % n, F.lit(-1)).cast("int")


def give_back() -> None:
    """Return memory that a block has freed to the system: workers live on,
    and an executor's limit counts what they hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Regroup Arrow batches into tables of about ``limit`` bytes of text.
    A longer text is a block of its own; it is never cut."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64)) + size
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, limit, side="left")) + 1
            stop = max(start + 1, min(stop, batch.num_rows))
            held.append(batch.slice(start, stop - start))
            size = int(ends[stop - 1])
            if size >= limit:
                yield pa.Table.from_batches(held).combine_chunks()
                ends = ends - size
                held, size = [], 0
                give_back()
            start = stop
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
        held.clear()
        give_back()


def one_array(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    return column


def texts_of(block: pa.Table, text: str) -> pa.Array:
    """The text column without nulls (null: empty)."""
    return pc.fill_null(one_array(block.column(text)), "")


def interned(lists: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(codes, distinct values, offsets per row) of a list-of-strings array,
    without its empty strings."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    offsets = offsets - offsets[0]
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, offsets


def words_of(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text, A-Z lower-cased if asked:
    (codes, distinct words, offsets per text)."""
    if lower:
        texts = pc.ascii_lower(texts)
    return interned(pc.ascii_split_whitespace(texts))


def sums_by_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each row's span (0 for an empty span)."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def ragged_take(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Concatenate the runs ``flat[starts[i]:starts[i]+lengths[i]]`` for i in ``which``."""
    n = lengths[which]
    total = int(n.sum())
    before = np.cumsum(n) - n
    at = np.repeat((starts[which] - before).astype(np.int64), n)
    at += np.arange(total)
    return flat[at]


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finalizer of the splitmix64 generator)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def hashes_of(values: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct strings."""
    import xxhash
    h = xxhash.xxh3_64_intdigest
    raw = values.cast(pa.binary()).to_pylist()
    return np.fromiter(map(h, raw), dtype=np.uint64, count=len(raw))
