"""WARC archives compressed with Zstandard: writer and validating reader.

An archive starts with a skippable frame that holds the dictionary; after it,
every record is one frame compressed with that dictionary. The reader loads
the dictionary from the leading frame, decodes one frame per record and checks
headers and lengths; anything out of order raises ``WarcError``.

``write_archives`` gives rows (path, content), the shape of Spark's
``binaryFile`` source, so the reader takes either those rows or
``spark.read.format("binaryFile").load("....warc.zst")``.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.shared import slices, stored, text_bytes

# Fixed values of the formats: skippable frame that holds a dictionary, frame magics, profile of a revisit.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = (b"warc-type", b"warc-record-id", b"warc-date", b"content-length")

DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 1 << 20
EPOCH = b"1970-01-01T00:00:00Z"


class WarcError(ValueError):
    """An archive that breaks the format."""


def base32_sha1(payload: bytes) -> bytes:
    return base64.b32encode(hashlib.sha1(payload).digest())


# --- writing -----------------------------------------------------------------------------------


def record(page_id: int | None, url: bytes | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record. A revisit has the HTTP header alone; its
    Content-Length there and its payload digest are those of the full payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response")]
    head += [b"WARC-Record-ID: <urn:page:%s>" % _id(page_id), b"WARC-Date: " + EPOCH]
    if url is not None:
        head.append(b"WARC-Target-URI: " + b"".join(b"%%%02X" % c if c <= 0x20 else bytes([c]) for c in url))
    if revisit:
        head += [b"WARC-Profile: " + REVISIT_PROFILE, b"WARC-Refers-To: <urn:page:%s>" % _id(refers_to)]
    head += [b"WARC-Payload-Digest: sha1:" + base32_sha1(payload), b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _id(page_id: int | None) -> bytes:
    return b"null" if page_id is None else b"%d" % page_id


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        raw = b"".join(samples)[-DICTIONARY_BYTES:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive_head(dictionary_: zstandard.ZstdCompressionDict) -> bytes:
    held = zstandard.ZstdCompressor(level=3).compress(dictionary_.as_bytes())
    return struct.pack("<II", DICTIONARY_MAGIC, len(held)) + held


def archives(records: Iterator[bytes], size: int) -> Iterator[bytes]:
    """Archives of about ``size`` bytes. An archive's dictionary is made from
    its first records, ``SAMPLE_BYTES`` at most."""
    waiting: list[bytes] = []
    waited, out, packer = 0, bytearray(), None

    def start() -> zstandard.ZstdCompressor:
        sample, used = [], 0
        for r in waiting:
            sample.append(r[: SAMPLE_BYTES - used])
            used += len(sample[-1])
            if used >= SAMPLE_BYTES:
                break
        made = dictionary(sample)
        out.extend(archive_head(made))
        packed = zstandard.ZstdCompressor(level=3, dict_data=made, write_checksum=True)
        for r in waiting:
            out.extend(packed.compress(r))
        waiting.clear()
        return packed

    for r in records:
        if packer is None:
            waiting.append(r)
            waited += len(r)
            if waited >= SAMPLE_BYTES:
                packer, waited = start(), 0
        else:
            out.extend(packer.compress(r))
        if len(out) >= size:
            yield bytes(out)
            out, packer = bytearray(), None
    if waiting:
        start()
    if out:
        yield bytes(out)


def write_archives(pages: DataFrame, archive_bytes: int = 16 << 20) -> DataFrame:
    """Rows (path, content) of archives holding a record per row of ``pages``
    (page_id, url, html; other columns are ignored), by partition.

    Of rows with equal payloads (SHA-1 and length) that with the largest
    page_id is a response and the others revisit it; rows that repeat that
    page_id are responses too, as are rows whose group has no page_id. Null
    html is an empty payload. An empty table gives no archive.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("binary").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    same = rows.select("page_id", "digest", F.length("payload").alias("n")).groupBy("digest", "n").agg(
        F.max("page_id").alias("response"), F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("digest", "response")
    # the groups of several rows are written first: the planner then knows their size and moves pages only where they are too many to send
    same = stored(same, "warc-copies")
    rows = rows.join(same, "digest", "left").drop("digest").withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = 0

        def records() -> Iterator[bytes]:
            nonlocal part
            for batch in slices(batches):
                part = batch.column("part")[0].as_py()
                for page, url, held, response in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), text_bytes(batch.column("payload")), batch.column("response").to_pylist(), strict=True):
                    yield record(page, url, held, response, response is not None and page != response)

        for k, content in enumerate(archives(records(), archive_bytes)):
            yield pa.RecordBatch.from_pydict({"path": pa.array(["part-%05d-%05d.warc.zst" % (part, k)]), "content": pa.array([content], pa.binary())})

    return rows.mapInArrow(run, "path string, content binary")


# --- reading -----------------------------------------------------------------------------------


def _headers(lines: list[bytes], what: str) -> dict[bytes, bytes]:
    out: dict[bytes, bytes] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"{what}: malformed header line {line[:80]!r}")
        out[name.lower()] = value.strip()
    return out


def _length(headers: dict[bytes, bytes], what: str) -> int:
    value = headers.get(b"content-length", b"")
    if not value.isdigit():
        raise WarcError(f"{what}: Content-Length is {value!r}")
    return int(value)


def parse_record(data: bytes) -> tuple[dict[bytes, bytes], int, bytes | None]:
    """(headers, length of the full payload, the payload or None for a revisit)."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or not lines[0].startswith(b"WARC/1."):
        raise WarcError(f"not a WARC record: {data[:40]!r}")
    headers = _headers(lines[1:], "WARC header")
    if missing := [x for x in REQUIRED if x not in headers]:
        raise WarcError(f"missing {missing[0].decode()}")
    size = _length(headers, "WARC header")
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"block of {len(rest) - 4} bytes, Content-Length {size}")
    http, blank, body = rest[:size].partition(b"\r\n\r\n")
    if not blank or not http.startswith(b"HTTP/1."):
        raise WarcError("block without an HTTP header")
    full = _length(_headers(http.split(b"\r\n")[1:], "HTTP header"), "HTTP header")
    digest = headers.get(b"warc-payload-digest", b"")
    if not digest.startswith(b"sha1:"):
        raise WarcError(f"payload digest {digest!r}")
    kind = headers[b"warc-type"]
    if kind == b"revisit":
        if body or b"warc-refers-to" not in headers or headers.get(b"warc-profile") != REVISIT_PROFILE:
            raise WarcError("malformed revisit")
        return headers, full, None
    if kind != b"response":
        raise WarcError(f"record type {kind!r}")
    if len(body) != full:
        raise WarcError(f"payload of {len(body)} bytes, Content-Length {full}")
    if base32_sha1(body) != digest[5:]:
        raise WarcError("payload doesn't match its digest")
    return headers, full, body


def read_records(content: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame each."""
    if len(content) < 8:
        raise WarcError("no dictionary frame")
    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_MAGIC or 8 + size > len(content):
        raise WarcError("the archive doesn't start with a whole dictionary frame")
    held = content[8 : 8 + size]
    if held[:4] == struct.pack("<I", FRAME_MAGIC):
        held = zstandard.ZstdDecompressor().decompress(held)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
    rest = memoryview(content)[8 + size :]
    while rest:
        frame = unpacker.decompressobj()
        parts, at = [], 0
        while not frame.eof and at < len(rest):
            parts.append(frame.decompress(rest[at : at + (1 << 16)]))
            at += 1 << 16
        if not frame.eof:
            raise WarcError("a frame is cut off")
        yield b"".join(parts)
        rest = rest[min(at, len(rest)) - len(frame.unused_data) :]


def read_archives(files: DataFrame) -> DataFrame:
    """The records of ``files`` (content, other columns are ignored): page_id,
    url, record_type, payload_bytes, payload_digest, refers_to, payload (null
    for a revisit). A broken archive raises ``WarcError``; a null content is
    broken. No files give no rows."""

    def page(value: bytes) -> int | None:
        number = value.removeprefix(b"<urn:page:").removesuffix(b">")
        return None if number == b"null" else int(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for data in read_records(content.as_py() or b""):
                    headers, size, payload = parse_record(data)
                    url = headers.get(b"warc-target-uri")
                    rows.append((
                        page(headers[b"warc-record-id"]), url and url.decode(), headers[b"warc-type"].decode(), size,
                        headers[b"warc-payload-digest"][5:].decode(), page(headers[b"warc-refers-to"]) if payload is None else None, payload))
                    held += len(payload or b"")
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)), schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)), schema=schema)

    return files.select("content").mapInArrow(
        run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")
