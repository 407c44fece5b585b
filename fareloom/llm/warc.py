"""WARC archives: writing by Spark's own writer, reading with salvage of what is left whole."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.session import written

END = b"\r\n\r\n"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
SENT = re.compile(rb"(?i)\r\ncontent-length: *(\d+)\r\n")
START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
#: Bytes of records that a file holds at most, unless one record is longer: a reader holds a file.
FILE_BYTES = 32 << 20
#: Bytes that a gzip member is fed at once, that it may hold, and that a record's header may have.
PIECE_BYTES, MEMBER_BYTES, HEAD_BYTES = 1 << 14, 1 << 30, 1 << 20
DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def mark_revisits(records: DataFrame, least: int = 1000) -> DataFrame:
    """``(id, url, payload)`` with ``payload_digest, payload_bytes, record_type, refers_to``.

    Of records with equal payloads of at least ``least`` bytes the one with the largest id is the
    response and the others revisit it; rows that share that id are all responses. Null payloads are
    empty. Null ids are never referred to.
    Payloads are equal if their SHA-256 is. Only groups of two or more make a table to look up, and
    the planner sends that table to the records or shuffles both, by its written size.
    """
    payload = F.coalesce(F.col("payload"), F.lit(b""))
    rows = records.select("id", "url", payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    rows = rows.withColumn("content", F.sha2("payload", 256))
    groups = (
        rows.where(F.col("payload_bytes") >= least).groupBy("content")
        .agg(F.count("*").alias("n"), F.max("id").alias("response")).where("n > 1").drop("n")
    )
    rows = rows.join(written(groups, "payload-groups"), "content", "left")
    revisits = F.coalesce(F.col("id") != F.col("response"), F.col("response").isNotNull())
    return rows.select(
        "id", "url", "payload", F.sha1("payload").alias("payload_digest"), "payload_bytes",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("response")).alias("refers_to"),
    )


def _record() -> Column:
    """A record as bytes, without the two line ends that close it."""
    eol = F.lit("\r\n")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    name = lambda c: F.concat(F.lit("<urn:page:"), text(c), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, eol)
    optional = lambda key, value: F.coalesce(line(key, value), F.lit(""))
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"),
    ).cast("binary")
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", name(F.col("id"))),
        line("WARC-Date", F.lit(DATE)),
        optional("WARC-Target-URI", url),
        F.when(revisit, line("WARC-Refers-To", name(F.col("refers_to")))).otherwise(""),
        F.when(revisit, line("WARC-Profile", F.lit(REVISIT))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(block))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        eol,
    )
    return F.concat(head.cast("binary"), block)


def write_archives(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write what :func:`mark_revisits` gives as archives of up to ``file_bytes``, or of one record.

    Each task joins its records to files, holding one at a time. The text writer puts a file's bytes
    down unchanged and ends it by its line separator, here the two line ends that close a record. So
    archives go to any storage that Spark writes to, and a lost task's files are not committed.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for record in batch.column("record"):
                data = record.as_py()
                if held and size + len(data) + len(END) > file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([END.join(held)], pa.binary())], names=["file"])
                    held, size = [], 0
                held.append(data)
                size += len(data) + len(END)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([END.join(held)], pa.binary())], names=["file"])

    files = records.select(_record().alias("record")).mapInArrow(joined, "file binary")
    (
        files.select(F.col("file").cast("string").alias("value"))
        .write.option("lineSep", END.decode())
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


@dataclass
class Part:
    """A record of an archive or, with a ``reason``, bytes that are none."""

    offset: int
    length: int
    reason: str | None = None
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    payload: bytes = b""


def _digest_fits(named: str | None, data: bytes) -> bool:
    """Does a ``sha1:`` label fit? Hexadecimal and base 32 are read; others are not judged."""
    kind, _, value = (named or "").partition(":")
    if kind.lower() != "sha1":
        return True
    digest = hashlib.sha1(data)
    return value.lower() == digest.hexdigest() or value == base64.b32encode(digest.digest()).decode()


def _record_at(data: bytes, at: int) -> Part | str:
    """The record that starts at a place, or why there is none."""
    if not VERSION.match(data, at):
        return "no version line"
    head_end = data.find(END, at, at + HEAD_BYTES)
    if head_end < 0:
        return "header not closed"
    headers: dict[str, str] = {}
    for row in data[at:head_end].split(b"\r\n")[1:]:
        name, colon, value = row.partition(b":")
        if not colon:
            return "header line without a colon"
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = headers.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        return "no content length"
    begin = head_end + len(END)
    end = begin + int(size)
    if end > len(data):
        return "cut off"
    if data[end : end + len(END)] != END:
        return "not closed where its length says"
    if not headers.get("warc-type") or not headers.get("warc-record-id"):
        return "no type or id"
    block = data[begin:end]
    if not _digest_fits(headers.get("warc-block-digest"), block):
        return "block digest differs"
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        cut = block.find(END)
        payload = block[cut + len(END) :] if cut >= 0 else b""
    if headers["warc-type"] != "revisit" and not _digest_fits(headers.get("warc-payload-digest"), payload):
        return "payload digest differs"
    return Part(at, end + len(END) - at, None, headers, block, payload)


def _member_at(data: bytes, at: int) -> tuple[bytes, int] | str:
    """The content of the gzip member at a place and the member's length, or why there is none.

    The member is fed in pieces until it ends, so what follows it costs nothing.
    """
    inflate, content, size, fed = zlib.decompressobj(31), [], 0, at
    while not inflate.eof:
        piece = inflate.unconsumed_tail
        if not piece:
            piece = data[fed : fed + PIECE_BYTES]
            fed += len(piece)
            if not piece:
                return "gzip member cut off"
        try:
            content.append(inflate.decompress(piece, 1 << 20))
        except zlib.error:
            return "gzip member damaged"
        size += len(content[-1])
        if size > MEMBER_BYTES:
            return "gzip member too large"
    return b"".join(content), fed - len(inflate.unused_data) - at


def salvage(data: bytes, compressed: bool = True) -> Iterator[Part]:
    """Records and gaps that together cover an archive, compressed by record or not at all.

    Where a check fails, the search goes on at the next version line or gzip member that passes every
    check; what lies before it is one gap. Offsets are those of the file; records that share a gzip
    member share its offset and length, and a gap inside a member is the member's. A member inside a
    member is no record. Each member is read once, whatever follows it; headers of over
    ``HEAD_BYTES`` and members of over ``MEMBER_BYTES`` are gaps.
    """
    at, gap, why = 0, -1, ""
    while at < len(data):
        found: list[Part] = []
        if compressed and data.startswith(b"\x1f\x8b\x08", at):
            member = _member_at(data, at)
            if isinstance(member, str):
                reason = member
            else:
                content, length = member
                found = [replace(p, offset=at, length=length) for p in salvage(content, False)]
                reason = "gzip member without a record"
                if all(p.reason for p in found):
                    found = []
        else:
            record = _record_at(data, at)
            if isinstance(record, str):
                reason = record
            else:
                found, length = [record], record.length
        if found:
            if gap >= 0:
                yield Part(gap, at - gap, why)
                gap = -1
            yield from found
            at += length
            continue
        if gap < 0:
            gap, why = at, reason
        later = START.search(data, at + 1)
        at = later.start() if later else len(data)
    if gap >= 0:
        yield Part(gap, len(data) - gap, why)


COLUMNS = (
    "file string, offset bigint, length bigint, reason string, record_type string, "
    "record_id string, target_uri string, refers_to string, date string, digest string, "
    "http_length bigint, payload binary"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record and every gap of the archives below a path: ``COLUMNS``.

    ``reason`` is null for records and names the failed check for gaps, the quarantine log. Empty
    files give no rows. Spark reads the files, wherever it can, one task's worth at a time; a file is
    held whole by its task, so archives should be written in files of up to some 100 MB.
    """
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in COLUMNS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows, size = [], 0
                for part in salvage(content.as_py() or b""):
                    h = part.headers
                    sent = SENT.search(part.block.partition(END)[0] + b"\r\n")
                    rows.append((
                        file.as_py(), part.offset, part.length, part.reason, h.get("warc-type"),
                        h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-refers-to"),
                        h.get("warc-date"), h.get("warc-payload-digest"),
                        int(sent[1]) if sent else None, None if part.reason else part.payload,
                    ))
                    size += part.length
                    if size > 8 << 20:
                        yield _batch(rows, names, schema)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names, schema)

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    return files.mapInArrow(run, COLUMNS)


def _batch(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, schema.field(n).type) for n, c in zip(names, zip(*rows, strict=True), strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)
