"""WARC archives and revisit resolution.

An archive is a folder of files of gzipped WARC/1.1 records, one gzip member
for each record.  Between members stands an empty member (``BETWEEN``), which
gzip readers skip; Spark's text writer puts it there as its line separator,
and Spark's text reader cuts files at it.  So a record is a row, files of any
size are read in parts by many tasks, and no task holds more than a record
and its batch.  Archives of other makers (``*.warc``, ``*.gz``) are read a
file at a time, as a stream of records.

``deduplicated`` resolves revisits.  Only headers (record id, digest, length,
reference) are shuffled: responses are grouped by the digest of their payload
and the one with the smallest page stays the response; all others become
revisits that refer to it.  Revisits that the input holds already are joined
to their originals, by the record that they refer to or else by digest, and
refer to the response that stands for it from now on.  A record without a
payload is never chosen as a response.  The decisions join the records, which
are written anew with fresh headers; headers that are not about identity,
length or reference are kept, and so are records of other types (warcinfo,
request, metadata and so on), references among them included.  ``resolved``
reads the new archive and joins revisits to the responses they refer to.

A digest that a third of all records have is reduced to its smallest page
before the shuffle (partial aggregation), and the join back on the digest is
one Spark can split; payloads are dealt by record id only.

Defined results: null html is an empty payload; records with equal payloads
of at least ``min_bytes`` bytes are one group, shorter ones are all
responses; of rows repeated under one page id one is the response and the
others revisit it; null page ids come last and are kept; null urls are
written as an empty target; a revisit whose original is not in the archive
stays as it is and refers to no page; records that repeat an id and a payload
are kept, each with that record's decision; deduplicating twice changes ids
only; a record that its file cuts short is an error; an empty table gives an
empty archive and an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, written

#: Records of one archive file at most; bytes that a task hands on at once.
FILE_RECORDS, AT_ONCE = 50_000, 8 << 20
#: Fixed values of the format.
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: An empty gzip member with a comment: the separator of records.
BETWEEN = bytes([31, 139, 8, 16, 0, 0, 0, 0, 0, 255]) + b"end of record\0" + bytes([3, 0]) + bytes(8)
#: Headers that name other records, and headers that are written anew.
REFERENCES = ("warc-concurrent-to", "warc-warcinfo-id", "warc-refers-to", "warc-segment-origin-id")
FRESH = ("warc-record-id", "warc-type", "warc-profile", "warc-refers-to", "warc-payload-digest", "x-payload-length", "content-length",
         "warc-block-digest")


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(text: str) -> str:
    """A header's value: line ends and other controls would end the header."""
    return "".join(c if c >= " " else " " for c in text)


def warc_record(kind: str, record_id: str, url: str | None, page_id: int | None, digest: str, size: int,
                payload: str, refers_to: str | None = None) -> str:
    """One record without its ending; ``size`` is that of the full payload."""
    block = payload.encode() if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record_id}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_one_line(url or '')}", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Payload-Length: {size}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:uuid:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(head) + "\r\n\r\n" + (payload if kind == "response" else "")


def parsed_lines(stream: BinaryIO) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """(header lines as (name, value), block) of each record of an archive, read as a stream."""
    while version := stream.readline():
        if not version.strip():                               # blank lines between records
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        lines: list[tuple[str, str]] = []
        while line := stream.readline().rstrip(b"\r\n").decode("utf-8", "replace"):
            if line[0] in " \t" and lines:                    # a folded line goes on with the one before
                lines[-1] = (lines[-1][0], f"{lines[-1][1]} {line.strip()}")
            else:
                name, _, value = line.partition(":")
                lines.append((name.strip(), value.strip()))
        size = next((int(v) for n, v in lines if n.lower() == "content-length"), None)
        block = stream.read(size or 0)
        if size is None or len(block) < size:
            raise ValueError("a record is cut short or has no length")
        yield lines, block


def parsed_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, read as a stream."""
    for lines, block in parsed_lines(stream):
        yield dict(lines), block


def _member(record: bytes) -> bytes:
    """One record as a gzip member that does not hold the separator."""
    for level in (1, 6, 9, 3):
        squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
        out = squeeze.compress(record + RECORD_END.encode()) + squeeze.flush()
        if BETWEEN not in out:
            return out
    raise ValueError("a record holds the separator at every level of compression")


def _members(records: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    """Compressed records in batches of bounded size."""
    held, size = [], 0
    for record in records:
        held.append(_member(record))
        size += len(held[-1])
        if size > AT_ONCE:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])
            held, size = [], 0
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])


def _write(members: DataFrame, folder: str) -> None:
    """Compressed records (column ``value``) as an archive in ``folder``; bytes are written as they are."""
    (members.select(F.col("value").cast("string").alias("value")).write.option("encoding", "ISO-8859-1")
     .option("lineSep", BETWEEN.decode("latin-1")).option("maxRecordsPerFile", FILE_RECORDS).text(folder))


def _files(spark: SparkSession, folder: str, names: str = "*") -> DataFrame:
    """(file, content) of every archive file in ``folder``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(folder)
    return files.select(F.col("path").alias("file"), "content")


def _stream(content: bytes) -> BinaryIO:
    return gzip.open(io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def _parsed_file(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one archive file."""
    yield from parsed_records(_stream(content))


def _serialised(lines: list[tuple[str, str]], block: bytes) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in lines) + "\r\n").encode() + block


def _opened(member: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Header lines and block of a record as ``_member`` has packed it."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    lines = [(n, v.strip()) for n, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])]
    return lines, rest[:-len(RECORD_END)]


def _import(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _members(_serialised(*record) for content in batch.column("content") for record in parsed_lines(_stream(content.as_py())))


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives in ``folder`` as a gzip member (column ``value``)."""
    own = (spark.read.option("pathGlobFilter", "*.txt").option("encoding", "ISO-8859-1")
           .option("lineSep", BETWEEN.decode("latin-1")).text(folder).select(F.col("value").cast("binary").alias("value")))
    foreign = _files(spark, folder, "*.{warc,gz}").mapInArrow(_import, "value binary")
    return own.where("octet_length(value) > 0").union(foreign)


def _payload(head: dict[str, str], block: bytes) -> tuple[bytes, bytes]:
    """(what stands before the payload in the block, the payload): HTTP headers do, where the block is a HTTP message."""
    if "application/http" in head.get("content-type", "").lower():
        before, end, payload = block.partition(b"\r\n\r\n")
        return (before + end, payload) if end else (block, b"")
    return b"", block


@dataclass
class _Record:
    """What one record says of itself."""

    lines: list[tuple[str, str]]
    block: bytes
    kind: str
    record_id: str
    page_id: int | None
    refers_to: str | None
    digest: str | None           # of the payload, computed; of a revisit, what its header says
    size: int | None

    @classmethod
    def of(cls, member: bytes) -> _Record:
        lines, block = _opened(member)
        head = {n.lower(): v for n, v in reversed(lines)}
        kind, said = head.get("warc-type", "").lower(), head.get("warc-payload-digest", "")
        digest, size = said.removeprefix("sha1:") if said.startswith("sha1:") else None, head.get("x-payload-length")
        if kind == "response":
            payload = _payload(head, block)[1]
            computed = payload_digest(payload)
            if "x-payload-length" in head and computed != digest:
                raise ValueError(f"payload of {head.get('warc-record-id')} does not have its digest")
            digest, size = computed, len(payload)
        page, own = head.get("x-page-id"), _id(head.get("warc-record-id"))
        return cls(lines, block, kind, own or hashlib.sha1(member).hexdigest(), int(page) if page else None,
                   _id(head.get("warc-refers-to")), digest, None if size is None else int(size))


def _id(header: str | None) -> str | None:
    """The bare id of a ``<urn:uuid:...>`` header; other ids as they are."""
    return header.strip("<> ").removeprefix("urn:uuid:") if header else None


_HEADERS = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
                      ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to_record", pa.string())])


def _read_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_Record.of(member.as_py()) for member in batch.column("value")]
        yield pa.RecordBatch.from_pylist([{
            "record_id": r.record_id, "record_type": r.kind, "page_id": r.page_id, "payload_digest": r.digest,
            "payload_bytes": r.size, "refers_to_record": r.refers_to} for r in found], schema=_HEADERS)


def read_headers(spark: SparkSession, folder: str) -> DataFrame:
    """What the headers of all records in ``folder`` say; payloads stay in their files, their digests are checked."""
    return records(spark, folder).mapInArrow(_read_headers, (
        "record_id string, record_type string, page_id long, payload_digest string, payload_bytes long, refers_to_record string"))


def _capture(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def lines() -> Iterator[bytes]:
        for batch in batches:
            for row, page, url, payload in zip(*[batch.column(c).to_pylist() for c in ("row", "page_id", "url", "html")]):
                raw = (payload or "").encode()
                yield warc_record("response", str(uuid.uuid5(uuid.NAMESPACE_OID, f"capture {row}")), url, page,
                                  payload_digest(raw), len(raw), payload or "").encode()
    yield from _members(lines())


def write_archive(pages: DataFrame, folder: str) -> None:
    """A full response record for every row of ``pages`` (page_id, url, html).

    Record ids come from the rows' places and are settled by writing the archive once.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), F.monotonically_increasing_id().alias("row"))
    _write(rows.mapInArrow(_capture, "value binary"), folder)


def revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(record_id, payload_digest, refers_to_record) of each record that repeats the payload of another.

    For revisits of the input, too, ``refers_to_record`` is the response that
    stands for the payload from now on; those without an original are left out.
    """
    responses = headers.where("record_type = 'response'")
    long_enough = responses.where(F.col("payload_bytes") >= min_bytes)
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "record_id")
    firsts = long_enough.groupBy("payload_digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    firsts = written(firsts.select("payload_digest", F.col("first.record_id").alias("first"), "n"))
    several = firsts.where("n > 1").select("payload_digest", F.col("first").alias("refers_to_record"))
    repeats = (long_enough.select("record_id", "payload_digest").join(several, "payload_digest").where("record_id <> refers_to_record")
               .select("record_id", "payload_digest", "refers_to_record"))
    # revisits of the input: by the record they refer to, else by digest; a short original stands for itself
    old = headers.where("record_type = 'revisit'").select("record_id", F.col("payload_digest").alias("own"), F.col("refers_to_record").alias("there"))
    originals = responses.groupBy(F.col("record_id").alias("there")).agg(F.min("payload_digest").alias("by_record"))
    old = old.join(originals, "there", "left").withColumn("payload_digest", F.coalesce("by_record", "own"))
    old = old.join(firsts.select("payload_digest", "first"), "payload_digest", "left")
    refers = F.coalesce("first", F.when(F.col("by_record").isNotNull(), F.col("there")))
    old = old.select("record_id", F.col("own").alias("payload_digest"), refers.alias("refers_to_record")).where("refers_to_record IS NOT NULL")
    return repeats.union(old).distinct()


def fresh_id(record_id: str) -> str:
    """The id of the new archive's record for one of the old."""
    return str(uuid.uuid5(uuid.NAMESPACE_OID, f"deduplicated {record_id}"))


def _urn(record_id: str) -> str:
    return f"<urn:uuid:{record_id}>"


def rewritten(record: _Record, refers_to: str | None) -> bytes:
    """The record with fresh headers; a revisit of ``refers_to`` if given, else what it is."""
    kept = [(n, _urn(fresh_id(_id(v))) if n.lower() in REFERENCES else v) for n, v in record.lines if n.lower() not in FRESH]
    kind, block = record.kind, record.block
    if refers_to and kind == "response":
        kind, block = "revisit", _payload({n.lower(): v for n, v in record.lines}, block)[0]
    head = [("WARC-Type", kind), ("WARC-Record-ID", _urn(fresh_id(record.record_id))), *kept]
    if kind in ("response", "revisit"):
        if record.digest is not None:
            head.append(("WARC-Payload-Digest", f"sha1:{record.digest}"))
        if record.size is not None:
            head.append(("X-Payload-Length", str(record.size)))
    else:
        head += [(n, v) for n, v in record.lines if n.lower() in ("warc-payload-digest", "warc-block-digest", "warc-profile")]
    if there := refers_to or record.refers_to:
        head.append(("WARC-Refers-To", _urn(fresh_id(there))))
    if kind == "revisit":
        head.append(("WARC-Profile", REVISIT_PROFILE))
    return _serialised([*head, ("Content-Length", str(len(block)))], block)


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _members(rewritten(_Record.of(member.as_py()), there) for batch in batches
                        for member, there in zip(batch.column("value"), batch.column("refers_to_record").to_pylist()))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_Record.of(member.as_py()) for member in batch.column("value")]
        yield pa.RecordBatch.from_arrays([pa.array([r.record_id for r in found]), pa.array([r.digest for r in found], pa.string()),
                                          batch.column("value")], names=["record_id", "digest", "value"])


def deduplicated(spark: SparkSession, raw: str, folder: str, min_bytes: int = 0) -> None:
    """The archives in ``raw`` written anew in ``folder``, repeated payloads as revisits.

    Records meet their decisions by id, compressed as they are; Spark
    broadcasts the decisions instead where their size allows it.
    """
    headers = written(read_headers(spark, raw))
    repeats = written(revisits(headers, min_bytes))
    keyed = records(spark, raw).mapInArrow(_keyed, "record_id string, digest string, value binary")
    found = keyed.join(repeats.select("record_id", F.col("payload_digest").alias("of"), "refers_to_record"),
                       (keyed["record_id"] == repeats["record_id"]) & F.col("digest").eqNullSafe(F.col("of")), "left")
    _write(found.select("value", "refers_to_record").mapInArrow(_rewrite, "value binary"), folder)


def resolved(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every response and revisit of a deduplicated archive."""
    found = written(read_headers(spark, folder))
    responses = found.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_record")).agg(
        F.min("page_id").alias("refers_to"), F.min("payload_digest").alias("digest_there"), F.min("payload_bytes").alias("bytes_there"))
    again = found.where("record_type = 'revisit'").join(responses, "refers_to_record", "left")
    wrong = F.col("digest_there") != F.col("payload_digest")
    again = again.withColumn("payload_digest", F.when(wrong, F.raise_error(F.lit("a revisit of another payload")))
                             .otherwise(F.coalesce("payload_digest", "digest_there")))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (found.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long")).select(*columns)
            .union(again.withColumn("payload_bytes", F.coalesce("bytes_there", "payload_bytes")).select(*columns)))


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages written as an archive, deduplicated into a second one, and read back from that."""
    spark = pages.sparkSession
    base = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, f"{base}/raw")
    deduplicated(spark, f"{base}/raw", f"{base}/deduplicated", min_bytes)
    return resolved(spark, f"{base}/deduplicated")
