"""One large JSON document read by many tasks.

The source system keeps all filings in one document, ``{"metadata": {...},
"filings": [{...}, ...]}``. Spark reads a multi-line JSON value in one task.
Here the text source cuts the file at every closing brace, which it can do
from any byte range, and three scans over the ranges find the elements:

1. how a range changes the state (inside a string or not, depth), for both
   possible states at its start. The driver links the ranges, one row each;
2. with its true start, whether a range ends inside the array and inside an
   element, and where that element began;
3. the elements. One that lies in a range is a row at once; the pieces of one
   that crosses ranges are put together by a grouping of those pieces alone.

Elements that aren't objects are skipped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tokens that matter, and the rest of a string that began earlier.
_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*(?P<closed>")?|[{}\[\]:]', re.S)
_STRING_END = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.S)
#: depth inside the document's object, the array, an element
OBJECT, ARRAY, ELEMENT = 1, 2, 3


@dataclass
class Place:
    """Where a scan is: inside a string, how deep, inside the array."""
    string: bool = False
    depth: int = 0
    array: bool = False
    key: str | None = None      # the last string token in the document's object
    colon: bool = False         # a colon follows it


def segment(p: Place, text: str, name: str) -> tuple[int | None, bool]:
    """Move ``p`` over a segment, whose last character is its only closing
    brace outside strings. The offset at which an element begins in it, if one
    does, and whether an element ends with it."""
    at, begun, ended = 0, None, False
    if p.string:
        end = _STRING_END.match(text)
        if end is None:
            return None, False
        at, p.string = end.end(), False
    for m in _TOKEN.finditer(text, at):
        t = m.group()
        if t[0] == '"':
            if m.group("closed") is None:
                p.string = True
                break
            p.key, p.colon = (t, False) if p.depth == OBJECT else (None, False)
        elif t == ":":
            p.colon = p.key is not None
        elif t in "{[":
            if p.depth == OBJECT:
                p.array = t == "[" and p.colon and p.key == f'"{name}"'
            p.depth += 1
            if p.array and p.depth == ELEMENT and t == "{":
                begun = m.start()
        else:
            ended = p.array and p.depth == ELEMENT and t == "}"
            p.depth -= 1
            if p.depth < ARRAY:
                p.array = False
    return begun, ended


def write_array(elements: DataFrame, path: str, opening: str, closing: str) -> None:
    """Write one document: ``opening``, the JSON texts of ``elements`` (one
    column) in no given order, a line each, ``closing``. A file has one writer;
    its task holds no more than an Arrow batch, since the elements are computed
    before the exchange and aren't sorted."""
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(values: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([values], names=["value"])

        yield batch(pa.array([opening]))
        first = True
        for b in batches:
            values = b.column(0)
            if first and len(values):
                yield batch(values.slice(0, 1))
                values, first = values.slice(1), False
            yield batch(pc.binary_join_element_wise(",", values, ""))
        yield batch(pa.array([closing]))

    elements.repartition(1).mapInArrow(lines, "value string").write.text(path)


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    """The file cut at closing braces: path and start of the byte range, and
    the segments, in their order, of a range."""
    lines = spark.read.option("lineSep", "}").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """(file, start, segments) of a task's ranges: a range's rows are consecutive."""
    from itertools import groupby

    def rows():
        for b in batches:
            yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist())

    for (file, start), own in groupby(rows(), key=lambda r: (r[0], r[1])):
        yield file, start, (r[2] + "}" for r in own)


def _row(names: list[str], values: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(names, values))], schema=schema)


def read_array(spark: SparkSession, path: str, name: str = "filings") -> DataFrame:
    """(file, start, element): the JSON text of each object in the array
    ``name`` of the document at ``path`` (or of each document in a folder)."""
    ranges = _ranges(spark, path)

    def deltas(batches):
        schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("out", pa.bool_()), ("down", pa.int64()), ("out_in", pa.bool_()), ("down_in", pa.int64())])
        for file, start, texts in _by_range(batches):
            outside, inside = Place(), Place(string=True)
            for t in texts:
                segment(outside, t, name)
                segment(inside, t, name)
            yield _row(schema.names, [file, start, outside.string, outside.depth, inside.string, inside.depth], schema)

    places: dict[tuple[str, int], Place] = {}
    last, state = None, Place()
    for r in sorted(ranges.mapInArrow(deltas, "file string, start long, out boolean, down long, out_in boolean, down_in long").collect(), key=lambda r: (r["file"], r["start"])):
        if r["file"] != last:
            last, state = r["file"], Place()
        places[r["file"], r["start"]] = Place(state.string, state.depth)
        state = Place(r["out_in"] if state.string else r["out"], state.depth + (r["down_in"] if state.string else r["down"]))

    def ends(batches):
        """With the array's begin in another range unknown: both cases."""
        schema = pa.schema([("file", pa.string()), ("start", pa.int64()), *[(f"{k}{i}", pa.bool_()) for i in (0, 1) for k in ("array", "open", "own")]])
        for file, start, texts in _by_range(batches):
            known = places[file, start]
            cases = [Place(known.string, known.depth, array and known.depth >= ARRAY) for array in (False, True)]
            own = [False, False]
            for t in texts:
                for i, p in enumerate(cases):
                    begun, ended = segment(p, t, name)
                    own[i] = (own[i] or begun is not None) and not ended
            out = [x for i, p in enumerate(cases) for x in (p.array, p.array and p.depth >= ELEMENT, own[i])]
            yield _row(schema.names, [file, start, *out], schema)

    began: dict[tuple[str, int], int | None] = {}
    last, array, open_ = None, False, None
    shape = "file string, start long, array0 boolean, open0 boolean, own0 boolean, array1 boolean, open1 boolean, own1 boolean"
    for r in sorted(ranges.mapInArrow(ends, shape).collect(), key=lambda r: (r["file"], r["start"])):
        if r["file"] != last:
            last, array, open_ = r["file"], False, None
        key, which = (r["file"], r["start"]), int(array)
        places[key].array, began[key] = array and places[key].depth >= ARRAY, open_
        open_ = None if not r[f"open{which}"] else r["start"] if r[f"own{which}"] else open_
        array = r[f"array{which}"]

    def elements(batches):
        """Whole elements, and pieces: ``began`` is the start of the range in
        which the element began, null for a whole one."""
        schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("began", pa.int64()), ("element", pa.string())])

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for file, start, texts in _by_range(batches):
            known = places[file, start]
            p, held, since, rows = Place(known.string, known.depth, known.array), [], began[file, start], []
            for t in texts:
                inside = p.array and p.depth >= ELEMENT
                begun, ended = segment(p, t, name)
                if inside:
                    held.append(t)
                elif begun is not None:
                    held.append(t[begun:])
                if ended:
                    rows.append((file, start, since, "".join(held)))
                    held, since = [], None
                if len(rows) >= 2000:
                    yield batch(rows)
                    rows = []
            if held:
                rows.append((file, start, start if since is None else since, "".join(held)))
            if rows:
                yield batch(rows)

    found = ranges.mapInArrow(elements, "file string, start long, began long, element string")
    pieces = found.filter(F.col("began").isNotNull()).groupBy("file", "began").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "element"))), lambda s: s["element"]), "").alias("element"))
    return found.filter(F.col("began").isNull()).select("file", "start", "element").unionByName(pieces.select("file", F.col("began").alias("start"), "element"))
