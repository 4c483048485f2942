"""WARC archives with a salvaging reader (operator 6).

Writing. One record a page. Of pages with equal payloads of at least
``MIN_REVISIT`` bytes the one with the smallest page_id is written in full, as a
response; the others are revisits that refer to it and carry its digest. Who is a
revisit is found from row numbers, ids and digests alone, and the few decisions come to the
pages. Records are laid out by column expressions and written by Spark's text writer, whose
line separator is the empty line pair that ends a record, straight from the tasks that read
the pages: payloads cross the network only if the decisions are too many to be broadcast. An
archive holds at most ``ARCHIVE_BYTES`` of payload, however often a page repeats, or one
larger page, so a reading task's memory is bounded: pages are written by classes of size,
each with as many records an archive as its largest pages allow.

Reading. Spark reads whole archives, plain or gzipped a member per record. Every
record is checked: version line, header syntax, content length, the end of the
record, and the SHA-256 of the payload. After a failed check the reader searches
for the next gzip member or version line at which a whole valid record starts,
goes on there, and logs the bytes between as a quarantined gap with the reason.

Defined results: a null html is an empty payload; a null or empty url gives a
record without a target; control characters and spaces in urls are written
percent-encoded; a null page_id gives a record without one, a revisit if a page
with an id has the same payload; rows that repeat the smallest page_id are
responses all. Lone surrogates can't occur in Spark strings. Other columns aren't
read. An empty table gives archives without records and no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.llm.staging import numbered, staged

#: Payloads from so many bytes on are written once.
MIN_REVISIT = 100
#: Bytes of payload of an archive at most, but for larger single pages.
ARCHIVE_BYTES = 16 << 20
#: Largest payloads of the classes of size; a page beyond the last one has an archive of its own.
CLASSES = (4 << 10, 64 << 10, 1 << 20)
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Bytes that are inflated at once.
_PIECE = 1 << 16

_VERSION = re.compile(rb"WARC/\d\.\d\r\n")
_MEMBER = b"\x1f\x8b\x08"
_END = b"\r\n\r\n"
_PAGE = re.compile(r"<urn:x-page:(-?\d+)>")


def _line(name: str, value: Column) -> Column:
    """A header line; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _measured(pages: DataFrame) -> DataFrame:
    """``pages`` with ``bytes`` and ``digest`` of the payload."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.withColumns({"page_id": F.col("page_id").cast("long"), "bytes": F.octet_length(html).cast("long"), "digest": F.sha2(html.cast("binary"), 256)})


def revisits(digests: DataFrame) -> DataFrame:
    """(row, first) of the rows (row, page_id, bytes, digest) that are revisits: ``first`` is the page
    that they refer to."""
    large = digests.where(F.col("bytes") >= MIN_REVISIT)
    lead = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    return large.join(lead.select("digest", "first"), "digest").where(~F.col("first").eqNullSafe(F.col("page_id"))).select("row", "first")


def records(pages: DataFrame) -> DataFrame:
    """(page_id, bytes, record): the record of each row of ``pages`` (page_id, url, html, bytes, digest,
    first), as text."""
    again, html = F.col("first").isNotNull(), F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.col("url").cast("string")
    plain = F.when(url != "", url)
    coded = plain
    for code in (*range(0x21), 0x7F):
        coded = F.replace(coded, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    url = F.when(url.rlike(r"[\x00-\x20\x7F]"), coded).otherwise(plain)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(again, http).otherwise(F.concat(http, html))
    to = lambda c: F.concat(F.lit("<urn:x-page:"), c.cast("string"), F.lit(">"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.coalesce(to(F.col("page_id")), F.lit("<urn:x-page:none>"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Refers-To", F.when(again, to(F.col("first")))),
        _line("WARC-Profile", F.when(again, PROFILE)),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return pages.select("page_id", "bytes", F.concat(header, block).alias("record"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write the records of ``pages`` (page_id, url, html) as archives under ``path``."""
    rows = _measured(numbered(pages.select("page_id", "url", "html"), "row"))
    digests = staged(rows.select("row", "page_id", "bytes", "digest"), "warc-digests")
    again = staged(revisits(digests), "warc-revisits")
    largest = digests.agg(F.max("bytes")).first()[0] or 0

    for low, high in zip((-1, *CLASSES), (*CLASSES, 1 << 62), strict=True):
        if low < largest or low < 0:  # an empty table gives empty archives
            some = rows.where((F.col("bytes") > low) & (F.col("bytes") <= high)).join(again, "row", "left")
            out = records(some).select("record").write.mode("append").option("lineSep", "\r\n\r\n")
            out.option("maxRecordsPerFile", max(1, ARCHIVE_BYTES // high)).text(path)


@dataclass
class Record:
    """A checked record: where it lies and what it says."""

    offset: int
    length: int
    headers: dict[str, str]
    payload: bytes


class Damage(ValueError):
    """A failed check."""


def parse(data: bytes, at: int) -> Record:
    """The record that starts at ``at``; raises Damage with the reason."""
    if not _VERSION.match(data, at):
        raise Damage("no version line")
    end = data.find(_END, at)
    if end < 0:
        raise Damage("headers don't end")
    headers: dict[str, str] = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Damage("bad header line")
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    size = headers.get("content-length", "")
    if not size.isascii() or not size.isdigit():
        raise Damage("bad content length")
    start, stop = end + 4, end + 4 + int(size)
    if data[stop : stop + 4] != _END:
        raise Damage("record doesn't end where its length says")
    block = data[start:stop]
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        payload = block[block.find(_END) + 4 :] if _END in block else b""
    named = headers.get("warc-payload-digest", "")
    if named.startswith("sha256:") and headers.get("warc-type") != "revisit" and hashlib.sha256(payload).hexdigest() != named[7:].lower():
        raise Damage("payload digest differs")
    return Record(at, stop + 4 - at, headers, payload)


def _member(data: bytes, at: int) -> Record:
    """The record of the gzip member at ``at``."""
    inflate, parts, stop = zlib.decompressobj(31), [], at
    try:
        while not inflate.eof and stop < len(data):  # in pieces: what follows the member isn't copied
            piece = data[stop : stop + _PIECE]
            parts.append(inflate.decompress(piece))
            stop += len(piece)
    except zlib.error as e:
        raise Damage(f"bad gzip member: {e}") from e
    if not inflate.eof:
        raise Damage("gzip member doesn't end")
    plain = b"".join(parts)
    record = parse(plain, 0)
    if record.length != len(plain):
        raise Damage("gzip member holds more than a record")
    return Record(at, stop - at - len(inflate.unused_data), record.headers, record.payload)


def salvage(data: bytes) -> Iterator[Record | tuple[int, int, str]]:
    """All valid records of an archive in order, and (offset, length, reason) of each gap."""
    at = 0
    while at < len(data):
        try:
            record = _member(data, at) if data.startswith(_MEMBER, at) else parse(data, at)
        except Damage as damage:
            start, reason = at, str(damage)
            at, record = _resume(data, at + 1)
            yield start, at - start, reason
            if record is None:
                return
        yield record
        at = record.offset + record.length


def _resume(data: bytes, at: int) -> tuple[int, Record | None]:
    """The next place from ``at`` on where a whole valid record starts, and the record."""
    member, version = data.find(_MEMBER, at), _VERSION.search(data, at)
    while member >= 0 or version:
        here = min(x for x in (member, version.start() if version else -1) if x >= 0)
        try:
            return here, _member(data, here) if here == member else parse(data, here)
        except Damage:
            if here == member:
                member = data.find(_MEMBER, here + 1)
            else:
                version = _VERSION.search(data, here + 1)
    return len(data), None


_READ = (
    "archive string, offset long, length long, gap string, record_type string, page_id long, url string, "
    "payload_digest string, refers_to long, payload_bytes long, payload binary"
)


def _page(text: str | None) -> int | None:
    found = _PAGE.fullmatch(text or "")
    return int(found[1]) if found else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _READ.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in _READ.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            rows, held = [], 0
            for found in salvage(content.as_py()):
                if isinstance(found, Record):
                    h = found.headers
                    digest = h.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    own = (h.get("warc-type"), _page(h.get("warc-record-id")), h.get("warc-target-uri"), digest, _page(h.get("warc-refers-to")))
                    rows.append((path.as_py(), found.offset, found.length, None, *own, len(found.payload), found.payload))
                    held += len(found.payload)
                else:
                    rows.append((path.as_py(), *found, *[None] * 7))
                if held > 8 << 20:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives under ``path``: (archive, offset, length, gap,
    record_type, page_id, url, payload_digest, refers_to, payload_bytes, payload). ``gap``
    is the reason of a quarantined gap, null for a record; a revisit has no payload."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    return files.mapInArrow(_read, _READ)


def resolved(found: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of the records
    read; a revisit gets the payload size of the response that it refers to."""
    slim = found.where("gap is null").select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    full = slim.where("record_type = 'response' and page_id is not null").groupBy(F.col("page_id").alias("__to"), F.col("payload_digest").alias("__digest")).agg(F.max("payload_bytes").alias("__bytes"))
    out = slim.join(full, (F.col("refers_to") == F.col("__to")) & (F.col("payload_digest") == F.col("__digest")), "left")
    size = F.when(F.col("record_type") == "revisit", F.col("__bytes")).otherwise(F.col("payload_bytes"))
    return out.select("page_id", "url", size.alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
