"""WARC archives compressed frame by frame with Zstandard and a dictionary of their own.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds its dictionary, itself compressed; then comes
one Zstandard frame per record.  The writer trains a dictionary on the archive's first payloads, at most ``SAMPLES``
of ``SAMPLE_BYTES`` each; too few to train on become the dictionary as they are.  Archives are written by Spark's
text sink, a file each, so that they can go to any file system and a lost task leaves nothing half written; what the
sink puts behind every value is an empty skippable frame, which readers pass over.

The reader takes an archive as one binary row, loads the dictionary, walks the frames by their block headers,
decodes each and checks: version line, header syntax, the headers every record needs, that ``Content-Length`` and
the record's end agree, that a frame holds one record and no more, block and payload digests, and what a revisit
refers to.

Of pages with equal payloads of ``least_bytes`` or more the one with the largest id is a response, the others are
revisits of it without payload.  Payloads are compared by SHA-1 and length.

Defined results: a null html is an empty payload; rows that repeat the largest id of a payload are responses each; a
null id is below all others, and payloads that only rows without id have are all responses; a null url is left out;
an empty table writes no archive and gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.common import blocks

ARCHIVE_BYTES = 64 << 20
DICTIONARY_BYTES = 32 << 10
SAMPLES = 400
SAMPLE_BYTES = 8 << 10
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\0\0\0\0"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

_NAME = re.compile(rb"[!#$%&'*+\-.^_`|~0-9A-Za-z]+\Z")
_URN = re.compile(r"<urn:page:(.*)>\Z")
_NO_ID = "<urn:page-without-id>"


class BadRecord(ValueError):
    """An archive that does not hold what the format promises."""


def sha1_text(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(page_id) -> str:
    return _NO_ID if page_id is None else f"<urn:page:{quote(str(page_id), safe='')}>"


def id_of(name: str) -> str | None:
    if name == _NO_ID:
        return None
    if not (found := _URN.match(name)):
        raise BadRecord(f"not a record id of ours: {name}")
    return unquote(found[1])


def record(page_id, url: str | None, payload: bytes, digest: bytes, revisit_of) -> bytes:
    """A response, or a revisit where ``revisit_of`` is not null."""
    revisit = revisit_of is not None
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", urn(page_id)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Block-Digest", f"sha1:{sha1_text(block)}"),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(digest).decode()}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)))
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", urn(revisit_of))]
    headers.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in headers).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def dictionary_of(payloads: list[bytes]) -> bytes:
    samples = [payload[:SAMPLE_BYTES] for payload in payloads[:SAMPLES] if payload]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


class ArchiveWriter:
    def __init__(self, payloads: list[bytes]):
        content = dictionary_of(payloads)
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(content) if content else b""
        self.parts = [struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed]
        shared = zstandard.ZstdCompressionDict(content) if content else None
        if shared:
            shared.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True, write_content_size=True)
        self.size = 0

    def add(self, raw: bytes):
        self.parts.append(self.compressor.compress(raw))
        self.size += len(raw)

    def close(self) -> bytes:
        return b"".join(self.parts)


def frame_end(archive: memoryview, start: int) -> int:
    """Where the Zstandard frame at ``start`` ends, by its header and block sizes."""
    head = bytes(archive[start : start + 18])
    at = start + zstandard.frame_header_size(head)
    checksum = zstandard.get_frame_parameters(head).has_checksum
    while True:
        if at + 3 > len(archive):
            raise BadRecord("a frame is cut off")
        word = int.from_bytes(archive[at : at + 3], "little")
        at += 3 + (1 if (word >> 1) & 3 == 1 else word >> 3)
        if word & 1:
            break
    at += 4 * checksum
    if at > len(archive):
        raise BadRecord("a frame is cut off")
    return at


def frames(content: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive."""
    archive = memoryview(content)
    if len(archive) < 8 or struct.unpack_from("<I", archive)[0] != DICTIONARY_MAGIC:
        raise BadRecord("no dictionary frame at the start")
    at = 8 + struct.unpack_from("<I", archive, 4)[0]
    if at > len(archive):
        raise BadRecord("the dictionary frame is cut off")
    held = bytes(archive[8:at])
    if held[:4] == struct.pack("<I", FRAME_MAGIC):
        held = zstandard.ZstdDecompressor().decompress(held)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held)) if held else zstandard.ZstdDecompressor()
    while at < len(archive):
        if at + 8 > len(archive):
            raise BadRecord("bytes behind the last frame")
        magic, size = struct.unpack_from("<II", archive, at)
        if magic in SKIPPABLE:
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise BadRecord("neither a frame nor a skippable frame")
        try:
            end = frame_end(archive, at)
            yield decoder.decompress(archive[at:end])
        except zstandard.ZstdError as error:
            raise BadRecord(f"a frame cannot be decoded: {error}") from error
        at = end


def headers_of(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record that fills its frame exactly."""
    head, middle, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not middle or lines[0] != VERSION:
        raise BadRecord("no version line or no end of the headers")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not _NAME.match(name):
            raise BadRecord(f"not a header: {line[:60]!r}")
        if name.decode() in headers:
            raise BadRecord(f"header {name.decode()} occurs twice")
        headers[name.decode()] = value.strip(b" \t").decode()
    for name in NEEDED:
        if not headers.get(name):
            raise BadRecord(f"header {name} is missing")
    if not re.fullmatch(r"[0-9]+", headers["Content-Length"]):
        raise BadRecord("Content-Length is not a number")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadRecord(f"Content-Length says {length}, the frame holds {len(rest) - 4}")
    return headers, rest[:length]


def read_record(raw: bytes) -> dict:
    """The checked fields of a record."""
    headers, block = headers_of(raw)
    kind = headers["WARC-Type"]
    if kind not in ("response", "revisit"):
        raise BadRecord(f"unexpected record type {kind}")
    if headers.get("WARC-Block-Digest") != f"sha1:{sha1_text(block)}":
        raise BadRecord("the block digest does not fit the block")
    head, middle, payload = block.partition(b"\r\n\r\n")
    if not middle or not head.startswith(b"HTTP/"):
        raise BadRecord("the block is no HTTP response")
    size = int(headers.get("X-Payload-Length", len(payload)))
    digest = headers.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    if kind == "response" and (digest != sha1_text(payload) or size != len(payload)):
        raise BadRecord("digest or length do not fit the payload")
    refers_to = None
    if kind == "revisit":
        if payload or headers.get("WARC-Profile") != REVISIT_PROFILE or "WARC-Refers-To" not in headers or len(digest) != 32:
            raise BadRecord("a revisit that does not say what it refers to")
        refers_to = id_of(headers["WARC-Refers-To"])
    return {
        "page_id": id_of(headers["WARC-Record-ID"]),
        "url": headers.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": refers_to,
        "payload": payload if kind == "response" else None,
    }


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``text`` (the html), ``digest`` (SHA-1) and ``revisit_of`` (null for responses)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    digest = F.unhex(F.sha1(F.encode(html, "UTF-8")))
    size = F.octet_length(html)
    rows = pages.select("page_id", "url", html.alias("text"), digest.alias("digest"), size.alias("size"))
    shared = (
        rows.where(F.col("size") >= least_bytes)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND last IS NOT NULL")
        .select("digest", "size", "last")
    )
    # The narrow side is hashed, so rows with their html are not sorted; adaptive execution splits a digest that many share.
    joined = rows.join(shared.hint("shuffle_hash"), ["digest", "size"], "left")
    revisit = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return joined.select("page_id", "url", "text", "digest", revisit.alias("revisit_of"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES):
    """Write a record per row of ``pages`` to archives below ``folder``, each of about ``archive_bytes`` before
    compression."""

    def archives(batches):
        writer = None
        for batch, payloads in blocks(batches, "text"):
            writer = writer or ArchiveWriter(payloads)
            names = ("page_id", "url", "digest", "revisit_of")
            for payload, *more in zip(payloads, *(batch.column(name).to_pylist() for name in names)):
                page_id, url, digest, revisit_of = more
                writer.add(record(page_id, url, payload, digest, revisit_of))
            if writer.size >= archive_bytes:
                yield pa.RecordBatch.from_arrays([pa.array([writer.close()], pa.binary())], ["archive"])
                writer = None
        if writer:
            yield pa.RecordBatch.from_arrays([pa.array([writer.close()], pa.binary())], ["archive"])

    rows = with_revisits(pages, least_bytes).mapInArrow(archives, "archive binary")
    whole = rows.select(F.col("archive").cast("string").alias("value"))
    whole.write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(folder)


def read_archives(spark: SparkSession, folder: str, id_type: str = "long", payloads: bool = True) -> DataFrame:
    """One row per record below ``folder``; a record that fails a check ends the job with the file's name."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"][: 7 if payloads else 6]
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}

    def read(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows: list[dict] = []
                held = 0
                try:
                    for raw in frames(content.as_py()):
                        rows.append(read_record(raw))
                        held += len(raw)
                        if held > 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                except ValueError as error:
                    raise BadRecord(f"{path}: {error}") from error
                yield batch_of(rows)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([row[name] for row in rows], kinds.get(name, pa.string())) for name in names], names)

    fields = ", ".join(f"{name} {'long' if name == 'payload_bytes' else 'binary' if name == 'payload' else 'string'}" for name in names)
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    rows = files.mapInArrow(read, fields)
    return rows.withColumns({name: F.col(name).cast(id_type) for name in ("page_id", "refers_to")})
