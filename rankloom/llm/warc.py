"""WARC archives: writing with duplicate payloads as revisits, and a reader that salvages.

An archive folder has files of many records; in compressed files every record is a gzip member of
its own. Spark's text writer puts the records down byte for byte, with its commit protocol, on any
file system: plain records end with the two line breaks that separate them, and gzip members are
separated by an empty member, which adds nothing to the unpacked stream.

The reader checks each record (member checksum, header, length, digest). Where a check fails it looks
for the next valid member or version line behind the failure, goes on there, and logs the bytes between
as a quarantined gap. Files are read one per row; the writer bounds their size.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.durable import materialize
from rankloom.operators.skew import hot_keys, salted_join

# Payload bytes from which equal payloads are stored once, and the format's marks.
MIN_DEDUP_BYTES = 100
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
MAGIC = b"\x1f\x8b\x08"

#: Payload bytes of a file on average.
FILE_BYTES = 32 << 20

RECORDS = (
    "file string, offset long, length long, problem string, record_id string, page_id long, uri string, "
    "record_type string, refers_to_id string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)


def with_roles(pages: DataFrame) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to)`` of each page.

    Of equal payloads of at least 100 bytes the one with the smallest page_id is the response and the
    others revisit it. Rows that repeat this page_id are responses too; a null page_id is never the
    smallest. Payloads that many pages share are split over tasks.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn(
        "payload_digest", F.sha2("payload", 256)
    )
    # One row per payload that occurs twice; digests alone are read and shuffled for it.
    shared = (
        rows.where(F.col("payload_bytes") >= MIN_DEDUP_BYTES)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_page"), F.count("*").alias("n"))
        .where("n > 1 and first_page is not null")
    )
    shared = materialize(shared, "shared-payloads")
    joined = salted_join(
        rows, shared.select("payload_digest", "first_page"), "payload_digest", hot_keys(shared, "payload_digest", "n"),
        ["page_id"], "left",
    )
    repeats = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first_page")) & F.col("first_page").isNotNull(), F.lit(False))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(repeats, "revisit").otherwise("response").alias("record_type"),
        F.when(repeats, F.col("first_page")).alias("refers_to"),
    )


def _records(batches: Iterator[pa.RecordBatch], compress: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            body = b"" if row["record_type"] == "revisit" else row["payload"]
            uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", row["url"] or "")
            head = [
                VERSION.decode(),
                f"WARC-Type: {row['record_type']}",
                f"WARC-Record-ID: <urn:page:{'' if row['page_id'] is None else row['page_id']}>",
                f"WARC-Target-URI: {uri}",
                "WARC-Date: 1970-01-01T00:00:00Z",
                f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
                f"WARC-Block-Digest: sha256:{hashlib.sha256(body).hexdigest()}",
                f"X-Payload-Length: {row['payload_bytes']}",
                "Content-Type: text/html; charset=utf-8",
                f"Content-Length: {len(body)}",
            ]
            if row["record_type"] == "revisit":
                head[3:3] = [
                    f"WARC-Refers-To: <urn:page:{row['refers_to']}>",
                    "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                ]
            record = "\r\n".join(head).encode() + END + body
            if compress:
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                record = packer.compress(record + END) + packer.flush()
            out.append(record)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def write_warc(pages: DataFrame, path: str, compress: bool = True) -> None:
    """Write ``pages (page_id, url, html)`` as an archive folder, a record per row.

    A null html is an empty payload. Control characters and spaces of a url are percent-encoded.
    """
    rows = with_roles(pages)
    size = pages.agg(F.avg(F.octet_length(F.col("html").cast("string")))).first()[0] or 1.0
    records = rows.mapInArrow(lambda batches: _records(batches, compress), "record binary")
    separator = (EMPTY_MEMBER if compress else END).decode("latin-1")
    writer = records.select(F.col("record").cast("string").alias("value")).write
    writer.option("lineSep", separator).option("encoding", "ISO-8859-1").option(
        "maxRecordsPerFile", max(1, int(FILE_BYTES / max(size, 1.0)))
    ).text(path)


_HEADER = re.compile(rb"WARC/1\.[01]\r\n((?:[^\r\n]+\r\n)+)\r\n")


#: Digests that the reader checks; archives write them in hex or in base 32.
DIGESTS = frozenset("md5 sha1 sha256 sha512".split())


def _number(text: str) -> int | None:
    """A whole number in plain digits that fits 64 bits."""
    return int(text) if re.fullmatch(r"[0-9]{1,18}", text) else None


def _agrees(digest: str, block: bytes) -> bool:
    """Whether a block has its digest; digests of an unknown kind say nothing."""
    kind, _, value = digest.partition(":")
    kind, value = kind.strip().lower().replace("-", ""), value.strip()
    if kind not in DIGESTS or not value:
        return True
    found = hashlib.new(kind, block).digest()
    return value.lower() == found.hex() or value.upper().rstrip("=") == base64.b32encode(found).decode().rstrip("=")


def _parsed(data: bytes, at: int, last: bool) -> tuple[int, dict | None, bytes, str]:
    """``(end, fields, block, problem)`` of the record at ``at``; ``last`` if nothing may follow it."""
    match = _HEADER.match(data, at)
    if not match:
        return at, None, b"", "no valid header"
    fields = {}
    for line in match.group(1).split(b"\r\n"):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    size = _number(fields.get("content-length", ""))
    if size is None:
        return at, None, b"", "no content length"
    end = match.end() + size
    if end + len(END) > len(data) or data[end : end + len(END)] != END:
        return at, None, b"", "wrong length"
    block = data[match.end() : end]
    if not _agrees(fields.get("warc-block-digest", ""), block):
        return at, None, b"", "wrong block digest"
    if last and end + len(END) != len(data):
        return at, None, b"", "bytes behind the record"
    return end + len(END), fields, block, ""


def _member(data: memoryview, at: int) -> tuple[int, bytes | None, str]:
    """``(end, content, problem)`` of the gzip member at ``at``."""
    unpacker = zlib.decompressobj(31)
    parts, position = [], at
    try:
        while not unpacker.eof and position < len(data):
            parts.append(unpacker.decompress(data[position : position + (1 << 20)]))
            position += 1 << 20
    except zlib.error as error:
        return at, None, f"bad member: {error}"
    if not unpacker.eof:
        return at, None, "cut member"
    return min(position, len(data)) - len(unpacker.unused_data), b"".join(parts), ""


def salvage(data: bytes, packed: bool | None = None) -> Iterator[tuple[int, int, dict | None, bytes, str]]:
    """``(offset, length, fields, block, problem)`` of each record of a file, and of each gap between
    records: its fields are None, and the problem says why the first check failed.

    The content of a member that is not one record is searched like a plain file; what is found there has
    the offset and length of the member.
    """
    if packed is None:
        packed = data[:2] == MAGIC[:2] or (not data.startswith(b"WARC/") and MAGIC in data)
    view = memoryview(data)

    several: list[tuple[int, int, dict | None, bytes, str]] = []

    def read(at: int) -> tuple[int, dict | None, bytes, str]:
        several.clear()
        if not packed:
            return _parsed(data, at, False)
        if data[at : at + 3] != MAGIC:
            return at, None, b"", "no member"
        end, content, problem = _member(view, at)
        if content is None:
            return at, None, b"", problem
        if not content:
            return end, {}, b"", ""
        _, fields, block, problem = _parsed(content, 0, True)
        if fields is None:
            several.extend(salvage(content, False))
            if any(part[2] is not None for part in several):
                return end, {}, b"", ""
            several.clear()
        return (end if fields is not None else at), fields, block, problem

    mark = MAGIC if packed else b"WARC/1."
    at, gap, why = 0, None, ""
    while at < len(data):
        end, fields, block, problem = read(at)
        if fields is not None:
            if gap is not None:
                yield gap, at - gap, None, b"", why
                gap = None
            if fields:  # an empty member separates records
                yield at, end - at, fields, block, ""
            for start, length, *part, problem in several:
                where = f" at {start} to {start + length} of the member's content" if problem else ""
                yield at, end - at, *part, problem + where
            at = end
            continue
        if gap is None:
            gap, why = at, problem
        at = data.find(mark, at + 1)
        if at < 0:
            break
    if gap is not None:
        yield gap, len(data) - gap, None, b"", why


def _page(text: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]{1,19})>", text)
    return int(found.group(1)) if found and -(1 << 63) <= int(found.group(1)) < 1 << 63 else None


def _identity(text: str | None) -> str | None:
    """A record's id, of whatever kind, without its brackets."""
    return text.removeprefix("<").removesuffix(">") if text else None


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all files of an archive, one row each (``RECORDS``).

    ``problem`` is null for a record. For a gap it has the failed check, and ``offset`` and ``length``
    the quarantined bytes. A revisit has no payload; its ``payload_bytes`` and ``payload_digest`` are
    those of the page it refers to, null where the record does not say them. ``record_id`` and ``refers_to_id`` are ids of any
    kind; ``page_id`` and ``refers_to`` are null for ids that :func:`write_warc` did not write. No bytes make the reader fail:
    a header that is none, a length that is no number and a digest that disagrees are gaps. Files whose names begin with an underscore or a point are not of
    the archive. An empty folder gives no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("problem", pa.string()),
                 ("record_id", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()), ("record_type", pa.string()),
                 ("refers_to_id", pa.string()), ("refers_to", pa.int64()),
                 ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
        schema = pa.schema(types)

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema
            )

        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                rows, held = [], 0
                for offset, length, fields, block, problem in salvage(content.as_py()):
                    if fields is None:
                        rows.append((name.as_py(), offset, length, problem, *[None] * 9))
                    else:
                        revisit = fields.get("warc-type") == "revisit"
                        size = _number(fields.get("x-payload-length", "")) if revisit else len(block)
                        digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
                        own, other = fields.get("warc-record-id", ""), fields.get("warc-refers-to", "")
                        rows.append((
                            name.as_py(), offset, length, None, _identity(own), _page(own), fields.get("warc-target-uri"),
                            fields.get("warc-type"), _identity(other), _page(other), size,
                            digest if revisit else hashlib.sha256(block).hexdigest(), None if revisit else block,
                        ))
                    held += len(block)
                    if held > 4 << 20 or len(rows) >= 2000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(read, RECORDS)


def records(found: DataFrame) -> DataFrame:
    """The records of :func:`read_warc`."""
    return found.where("problem is null").drop("problem")


def gaps(found: DataFrame) -> DataFrame:
    """``(file, offset, length, problem)``: the log of quarantined bytes."""
    return found.where("problem is not null").select("file", "offset", "length", "problem")
