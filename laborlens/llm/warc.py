"""WARC archives of pages: writing with revisit records, and a reader that salvages damaged archives.

Every record is a gzip member of its own. Members are put together to archives of a few MiB in Spark tasks and
written by Spark's text writer, one archive a file, so they reach any file system that Spark does. The reader checks
every member and record; after a failed check it searches for the next valid member or version line, goes on from
there, and reports the bytes in between as a quarantined gap.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import lean, small, stored

LEAST_REVISIT = 1000
ARCHIVE_BYTES = 4 << 20
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
MEMBER = b"\x1f\x8b\x08"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes that a member is unpacked by, at first and at most; a header has so many bytes at most.
FIRST_STEP, STEP_BYTES, HEADER_BYTES = 1 << 11, 1 << 20, 1 << 16
#: Bytes that a reader holds before it passes rows on, and bytes that a row counts for besides its block.
PASSED_BYTES, ROW_BYTES = 8 << 20, 200
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")


def record(page_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record: a response, or a revisit of the record of ``refers_to``, whose block has no payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{quote(page_id)}>"),
        ("WARC-Date", DATE), ("WARC-Target-URI", None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("WARC-Refers-To", None if refers_to is None else f"<urn:page:{quote(refers_to)}>"), ("WARC-Profile", None if refers_to is None else REVISIT),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode()
    return VERSION + lines + b"\r\n" + block + b"\r\n\r\n"


def member(content: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


@dataclass
class Record:
    """A valid record, or the gap of bytes that gave none (``reason``)."""

    offset: int
    length: int
    fields: dict[str, str] | None = None
    block: bytes = b""
    reason: str | None = None


def _parse(data: bytes, at: int) -> Record | str:
    """The record at a version line, or why there is none."""
    line = VERSION_LINE.match(data, at)
    if not line:
        return "no version line"
    end = data.find(b"\r\n\r\n", at, at + HEADER_BYTES)
    if end < 0:
        return "no end of header"
    fields = {}
    for part in data[line.end():end].split(b"\r\n"):
        name, colon, value = part.partition(b":")
        if not colon:
            return "bad header line"
        fields[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        return "no content length"
    start = end + 4
    stop = start + int(size)
    if data[stop:stop + 4] != b"\r\n\r\n":
        return "no end of record"
    block = data[start:stop]
    digest = fields.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:].lower() != hashlib.sha1(block).hexdigest():
        return "block digest differs"
    return Record(at, stop + 4 - at, fields, block)


def _plain(data: bytes) -> Iterator[Record]:
    """Records of uncompressed bytes, with gaps; offsets count within the bytes."""
    at = gap = 0
    reason = None
    while at < len(data):
        found = _parse(data, at)
        if isinstance(found, Record):
            if gap < at:
                yield Record(gap, at - gap, reason=reason)
            yield found
            at = gap = at + found.length
            continue
        reason = reason if gap < at and reason else found
        following = VERSION_LINE.search(data, at + 1)
        at = following.start() if following else len(data)
    if gap < at:
        yield Record(gap, at - gap, reason=reason)


def _member(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What a member holds, its length, and why it ends before its end; a failed one gives what came out before.

    It is unpacked in steps that grow with it, so the bytes behind it are never copied as a whole. A step that fails
    gives nothing of what it unpacked and is taken once more in halves, down to the byte that fails.
    """
    view, unpacker, parts = memoryview(data), zlib.decompressobj(31), []
    place, step, failed = at, FIRST_STEP, None
    while place < len(data) and not unpacker.eof:
        before = unpacker.copy()
        try:
            parts.append(unpacker.decompress(view[place:place + step]))
            place = min(place + step, len(data))
            step = step if failed else min(2 * step, STEP_BYTES)
        except zlib.error as error:
            failed = failed or f"bad member: {error}"
            if step == 1:
                break
            unpacker, step = before, step // 2
    if failed is None and not unpacker.eof:
        failed = "member ends early"
    return b"".join(parts), place - at - len(unpacker.unused_data), failed


def salvage(data: bytes) -> Iterator[Record]:
    """Every valid record of an archive, and the gaps; zero bytes between members are padding.

    Offsets are those in the archive; records of one member share the member's. A member whose records are damaged
    gives those that are valid, and one gap of the member's own bytes. A member that can't be unpacked to its end gives
    the records before the error that have a valid block digest and end where the next one starts or nothing follows;
    the gap is that of its bytes.
    """
    at = gap = 0
    reason = None
    given: list[tuple] = []  # by the last member that failed; its bytes may show them once more

    def closed(to: int) -> Iterator[Record]:
        if gap < to:
            yield Record(gap, to - gap, reason=reason)

    while at < len(data):
        if data[at] == 0 and gap == at:
            at = gap = at + 1
            continue
        if data.startswith(MEMBER, at):
            content, size, found = _member(data, at)
            inner = list(_plain(content))
            if found:
                ends = lambda r: r.offset + r.length == len(content) or VERSION_LINE.match(content, r.offset + r.length)
                whole = [r for r in inner if r.reason is None and r.fields.get("warc-block-digest", "").startswith("sha1:") and ends(r)]
                if whole:
                    yield from closed(at)
                    gap = at
                    given = [(r.fields, r.block) for r in whole]
                    for r in whole:
                        yield Record(at, size, r.fields, r.block)
            else:
                yield from closed(at)
                for r in inner:
                    if r.reason is None:
                        yield Record(at, size, r.fields, r.block)
                if bad := next((r.reason for r in inner if r.reason), None):
                    yield Record(at, size, reason=f"in a member: {bad}")
                at = gap = at + size
                continue
        else:
            found = _parse(data, at)
            if isinstance(found, Record) and gap < at and (found.fields, found.block) in given:
                at += found.length
                continue
            if isinstance(found, Record):
                yield from closed(at)
                yield found
                at = gap = at + found.length
                continue
        if gap == at:
            reason = found
        following = START.search(data, at + 1)
        at = following.start() if following else len(data)
    yield from closed(at)


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``id, url, html, digest, refers_to``: of equal payloads of a least size, all but the largest id revisit that one.

    A null page is empty. A row without id is a response unless a row with an id has the same payload. Rows with the
    largest id twice are both responses.
    """
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")).withColumn(
        "digest", F.sha1("html"))
    sized = rows.filter(F.octet_length("html") >= LEAST_REVISIT).select("id", "digest")
    again = stored(sized.groupBy("digest").agg(F.count("*").alias("n"), F.max("id").alias("refers_to")).filter("n > 1 AND refers_to IS NOT NULL").select(
        F.col("digest").alias("again"), "refers_to"), "revisits")
    joined = rows.join(small(again), F.col("digest") == F.col("again"), "left")
    other = ~F.col("id").eqNullSafe(F.col("refers_to"))
    return joined.select("id", "url", "html", "digest", F.when(other, F.col("refers_to")).alias("refers_to"))


def write_archives(planned: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write planned records as archives below ``path``; a zero byte of padding follows every archive."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
                packed = member(record(page_id, url, html.encode(), digest, refers_to))
                if held and size + len(packed) > archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])
                    held, size = [], 0
                held.append(packed)
                size += len(packed)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])

    text = planned.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "url", "html", "digest", F.col("refers_to").cast("string").alias("refers_to"))
    # the text writer puts a string's bytes into the file as they are
    archives = text.mapInArrow(build, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("lineSep", "\u0000").option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row a record or gap of all archives below ``path``.

    ``path, offset, length, record_type, id, url, refers_to, payload_bytes, payload_digest, payload, gap``: for a
    record ``gap`` is null; for a gap it is the reason and everything from ``record_type`` on is null. Size and
    digest are those of the full payload: a response's are taken from its bytes, and a response whose bytes don't
    have the digest of its header is a gap; a revisit's come from its headers. An archive must fit a task's memory.
    """
    names = ["path", "offset", "length", "record_type", "id", "url", "refers_to", "payload_bytes", "payload_digest", "payload", "gap"]
    schema = pa.schema(list(zip(names, [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(),
                                        pa.string(), pa.binary(), pa.string()])))

    def row(file: str, r: Record) -> tuple:
        place = (file, r.offset, r.length)
        if r.reason is not None:
            return *place, *[None] * 7, r.reason
        head, _, payload = r.block.partition(b"\r\n\r\n")
        fields = r.fields or {}
        kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:").lower()
        name, target = (unquote(fields[k][10:-1]) if fields.get(k, "").startswith("<urn:page:") else None for k in ("warc-record-id", "warc-refers-to"))
        if kind == "revisit":
            length = re.search(rb"(?i)^content-length: *(\d+)", head, re.M)
            size = int(length[1]) if length else None
        else:
            size, found = len(payload), hashlib.sha1(payload).hexdigest()
            if digest and digest != found:
                return *place, *[None] * 7, "payload digest differs"
            digest = found
        return *place, kind, name, fields.get("warc-target-uri"), target, size, digest, payload if payloads and kind != "revisit" else None, None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for r in salvage(content.as_py()):  # passed on as they come
                    rows.append(row(file, r))
                    size += len(r.block) + ROW_BYTES
                    if size > PASSED_BYTES:
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(lean(read), "path string, offset long, length long, record_type string, id string, url string, refers_to string, "
                                  "payload_bytes long, payload_digest string, payload binary, gap string")
