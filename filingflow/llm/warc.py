"""WARC archives compressed with Zstandard: one frame per record, a dictionary
in the leading skippable frame.

Writing. Pages meet the page that they repeat in a join on narrow rows (id and
payload digest), once by page. A worker gathers records up to
``ARCHIVE_BYTES`` and makes one archive of them: the skippable frame with a
dictionary trained on its own records, then a frame per record. An archive is
one row of Spark's text writer with one row per file, so any file system that
Spark writes to can hold archives; the row separator is an empty skippable
frame, which readers pass over.

Reading. Archives come as binary files, each small. The dictionary is taken
from the leading skippable frame, frames are decoded one at a time, and every
record's version line, headers, lengths and payload digest are checked.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_run_dir
from .common import blocks, one_array, prepare, stored
from .graph import hinted

#: fixed values of the formats
DICTIONARY_MAGIC, SKIPPABLE_LOW, SKIPPABLE_HIGH, FRAME_MAGIC = 0x184D2A5D, 0x184D2A50, 0x184D2A5F, 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: payload bytes of an archive, and of a dictionary
ARCHIVE_BYTES, DICTIONARY_BYTES = 8 << 20, 64 << 10
#: payload bytes from which an equal payload is written as a revisit
LEAST_REVISIT = 100
#: an empty skippable frame, between the rows of a file
EMPTY_FRAME = struct.pack("<II", SKIPPABLE_LOW, 0).decode("ascii")


def record_bytes(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    me = f"<urn:page:{'' if page_id is None else page_id}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {me}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive_bytes(records: list[bytes], level: int = 3) -> bytes:
    """An archive: the dictionary's skippable frame and a frame per record."""
    import zstandard
    taken, sample = 0, []
    for r in records[:: max(1, len(records) // 500)]:
        if taken > 2 << 20:
            break
        sample.append(r[:16 << 10])
        taken += len(sample[-1])
    try:
        trained = zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, taken // 8)), sample).as_bytes()
    except zstandard.ZstdError:
        trained = b"".join(sample)[:DICTIONARY_BYTES]  # too few records to train on: their text serves as it is
    given = zstandard.ZstdCompressionDict(trained)
    packed = zstandard.ZstdCompressor(level=19).compress(trained)
    press = zstandard.ZstdCompressor(level=level, dict_data=given, write_content_size=True, write_checksum=True)
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed + b"".join(map(press.compress, records))


class BadArchive(ValueError):
    """An archive or record that breaks the format."""


def frames(data: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive, one after the other."""
    import zstandard
    view, at, dictionary = memoryview(data), 0, None
    while at < len(data):
        if len(data) - at < 8:
            raise BadArchive(f"{len(data) - at} bytes left at {at}")
        magic, size = struct.unpack_from("<II", data, at)
        if SKIPPABLE_LOW <= magic <= SKIPPABLE_HIGH:
            if at + 8 + size > len(data):
                raise BadArchive(f"skippable frame at {at} is cut off")
            if at == 0:
                if magic != DICTIONARY_MAGIC:
                    raise BadArchive("the leading frame holds no dictionary")
                body = bytes(view[8:8 + size])
                if body[:4] == struct.pack("<I", FRAME_MAGIC):
                    body = zstandard.ZstdDecompressor().decompress(body)
                dictionary = zstandard.ZstdCompressionDict(body)
                reader = zstandard.ZstdDecompressor(dict_data=dictionary)
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise BadArchive(f"no frame at {at}")
        if dictionary is None:
            raise BadArchive("no dictionary frame in front")
        one, parts = reader.decompressobj(), []
        while not one.eof:
            if at >= len(data):
                raise BadArchive("the last frame is cut off")
            piece = view[at:at + (64 << 10)]
            try:
                parts.append(one.decompress(piece))
            except zstandard.ZstdError as e:
                raise BadArchive(f"frame at {at}: {e}") from e
            at += len(piece) - len(one.unused_data)
        yield b"".join(parts)


_PAGE = re.compile("<urn:page:(.*)>")


def parse_record(data: bytes) -> dict:
    """The parts of a record; BadArchive if a header, a length or the digest is wrong."""
    end = data.find(b"\r\n\r\n")
    if end < 0 or not data.startswith(VERSION + b"\r\n"):
        raise BadArchive("no WARC/1.1 header")
    fields: dict[str, str] = {}
    for line in data[len(VERSION) + 2:end].decode("utf-8", "strict").split("\r\n"):
        name, colon, value = line.partition(": ")
        if not colon or not name or name.lower() in fields:
            raise BadArchive(f"bad header line {line!r}")
        fields[name.lower()] = value
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in fields:
            raise BadArchive(f"no {name} header")
    kind = fields["warc-type"]
    if not fields["content-length"].isdecimal():
        raise BadArchive("Content-Length is no number")
    length = int(fields["content-length"])
    if len(data) != end + 4 + length + 4 or not data.endswith(b"\r\n\r\n"):
        raise BadArchive(f"Content-Length {length} doesn't fit {len(data) - end - 8} bytes")
    block = data[end + 4:end + 4 + length]
    http, gap, payload = block.partition(b"\r\n\r\n")
    m = re.search(rb"\r\nContent-Length: (\d+)(?:\r\n|$)", http)
    if not gap or not http.startswith(b"HTTP/1.1 ") or m is None:
        raise BadArchive("no HTTP header in the block")
    size, digest = int(m[1]), fields["warc-payload-digest"]
    me, other = _PAGE.fullmatch(fields["warc-record-id"]), _PAGE.fullmatch(fields.get("warc-refers-to", ""))
    if me is None or not re.fullmatch("sha256:[0-9a-f]{64}", digest):
        raise BadArchive("bad record id or digest")
    if kind == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest[7:]:
            raise BadArchive("the payload doesn't match its length or digest")
    elif kind == "revisit":
        if payload or other is None or fields.get("warc-profile") != REVISIT_PROFILE:
            raise BadArchive("a revisit with a payload, or without a target")
    else:
        raise BadArchive(f"record type {kind!r}")
    return {"page_id": me[1] or None, "url": fields.get("warc-target-uri"), "record_type": kind, "payload": payload if kind == "response" else None,
            "payload_bytes": size, "payload_digest": digest[7:], "refers_to": other[1] if kind == "revisit" else None}


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record per row of ``pages`` into archives under ``path``.

    The payload is the page in UTF-8 (null: empty). Of equal payloads of at
    least LEAST_REVISIT bytes the row with the smallest id is a response and
    the others revisit it; rows that repeat that id too are responses. A row
    with a null id is a revisit if a row with an id has its payload, else a
    response. A null url is left out; control characters in it are
    percent-encoded. An empty table writes no archive.
    """
    prepare(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    narrow = rows.where(F.octet_length("payload") >= LEAST_REVISIT).select("page_id", "digest")
    first = (narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
             .where("n > 1 AND refers_to IS NOT NULL").select("digest", "refers_to"))
    again = stored(narrow.join(first, "digest").where("page_id IS NULL OR page_id > refers_to")
                   .select(F.col("page_id").alias("id"), F.col("digest").alias("d"), "refers_to").distinct(), "revisits")
    records = rows.join(hinted(again, 120), F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("d")), "left").drop("id", "d")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "payload", ARCHIVE_BYTES):
            columns = [one_array(block.column(c)).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")]
            archive = archive_bytes([record_bytes(*r, date) for r in zip(*columns)])
            yield pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], names=["value"])

    # the string is the archive's bytes: Spark writes a string's bytes as they are
    (records.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("lineSep", EMPTY_FRAME).text(path))


def read_archives(spark, path: str, id_type: str = "long", payloads: bool = True) -> DataFrame:
    """A row per record of the archives under ``path``: page_id, url,
    record_type, payload (null for revisits; left out without ``payloads``),
    payload_bytes, payload_digest, refers_to, error.

    A record that fails a check is a row with ``error`` and nothing else; a
    damaged frame ends its archive with such a row.
    """
    prepare(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    names = ["page_id", "url", "record_type", *["payload"] * payloads, "payload_bytes", "payload_digest", "refers_to"]
    types = {"payload": pa.binary(), "payload_bytes": pa.int64()}

    def table(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], types.get(n, pa.string())) for n in [*names, "error"]], names=[*names, "error"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                try:
                    for data in frames(content.as_py()):
                        try:
                            rows.append(parse_record(data))
                        except (BadArchive, UnicodeDecodeError) as e:
                            rows.append({"error": f"{name}: {e}"})
                        size += len(data)
                        if size > ARCHIVE_BYTES:
                            yield table(rows)
                            rows, size = [], 0
                except BadArchive as e:
                    rows.append({"error": f"{name}: {e}"})
                yield table(rows)

    shape = ", ".join(f"{n} {'binary' if n == 'payload' else 'long' if n == 'payload_bytes' else 'string'}" for n in [*names, "error"])
    out = files.mapInArrow(run, shape)
    return out.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` into archives in the shared folder and read them back;
    a record that fails a check is an error. An empty table gives an empty
    result."""
    spark = pages.sparkSession
    path = new_run_dir(prepare(spark), "warc")
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType.simpleString()
    out = read_archives(spark, path, kind, payloads=False)
    return out.where(F.col("error").isNull() | F.raise_error(F.col("error")).isNotNull()).drop("error")
