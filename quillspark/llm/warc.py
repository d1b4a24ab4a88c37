"""WARC archives: a writer of one gzip member per record and a splittable reader.

Writing: members are made in the tasks and stored by Spark's text sink, so the
files reach any file system that Spark can write and a lost task's files are
never seen. Every member ends in a zero byte (the top byte of its length; a
record of 16 MB or more is followed by an empty member, which ends so too).
That byte is left to the sink, as its line separator.

Reading: a table of byte ranges is dealt over the tasks. A task looks for gzip
magic in its range, validates each candidate by decoding it up to the WARC
version line, and owns the records that start inside, reading past the end of
its range to finish the last one.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the WARC and gzip formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
VERSION_LINE = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
DEFAULT_DATE = "2000-01-01T00:00:00Z"

BLOCK, PIECE = 1 << 20, 1 << 16
PAGE_ID = "urn:x-page:"


def sha1_base32(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string or binary column."""
    digest = F.sha1(data)
    # 20 bits at a time: five hex digits are four base32 digits.
    parts = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), BASE32_HEX, BASE32)


def with_revisits(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """Add ``refers_to`` to (page_id, digest, size, …): the first page with the payload.

    Null for the first page itself, for payloads below ``min_bytes`` and for all
    rows of a payload that only pages without id have. Firsts are combined
    before the shuffle; only repeats travel to the join, on a narrow key.
    """
    narrow = pages.select("page_id", "digest", "size")
    first = (
        narrow.filter(F.col("size") >= min_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND first IS NOT NULL").select("digest", "first")
    )
    repeats = (
        narrow.join(first, "digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("first")))
        .groupBy("page_id", "digest").agg(F.min("first").alias("refers_to"))
        .select(F.col("page_id").alias("r_page_id"), F.col("digest").alias("r_digest"), "refers_to")
    )
    return pages.join(
        repeats,
        pages["page_id"].eqNullSafe(F.col("r_page_id")) & (pages["digest"] == F.col("r_digest")),
        "left",
    ).drop("r_page_id", "r_digest")


def _clean_uri(url: str | None) -> str:
    """White space and control characters would break the header."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP header but not the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    ident = "null" if page_id is None else page_id
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{PAGE_ID}{ident}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_clean_uri(url)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{PAGE_ID}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return VERSION_LINE + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


EMPTY_MEMBER = _gzip(b"", 6)


def member_bytes(record: bytes, level: int = 6) -> bytes:
    """The record's gzip member without its last byte, which is always zero."""
    member = _gzip(record, level)
    if member[-1]:
        member += EMPTY_MEMBER
    return member[:-1]


def write_warc(
    pages: DataFrame, path: str, *, id: str = "page_id", url: str = "url", html: str = "html",
    min_bytes: int = 0, date: str = DEFAULT_DATE, level: int = 6,
) -> None:
    """Write a record per row into archives below ``path``.

    The payload is the UTF-8 html, null as empty. Of the rows with equal
    payloads of at least ``min_bytes`` bytes the one with the smallest id is a
    response, as is every repeated row with that id; the others revisit it.
    Null ids never become the first page of a payload that has another; if it
    has none, all its rows are responses. A null url is written as
    ``about:blank``. Other columns are ignored; an empty table writes no record.
    """
    rows = pages.select(
        F.col(id).alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    ).withColumn("digest", sha1_base32(F.col("html").cast("binary"))).withColumn(
        "size", F.octet_length("html"))

    def members(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start in range(0, batch.num_rows, 64):  # bounded output batches
                cols = [batch.column(i).slice(start, 64).to_pylist() for i in range(batch.num_columns)]
                out = [
                    member_bytes(record_bytes(p, u, h.encode(), d, r, date), level)
                    for p, u, h, d, _, r in zip(*cols)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    marked = with_revisits(rows, min_bytes=min_bytes).select(
        "page_id", "url", "html", "digest", "size", "refers_to")
    (
        marked.mapInArrow(members, "value binary").select(F.col("value").cast("string"))
        .write.option("lineSep", "\x00").text(path)
    )


def _open(path: str):
    """Random access to a file, by the scheme of its path."""
    from pyarrow import fs

    local = re.sub(r"^file:/+", "/", path)
    if local.startswith("/"):
        return fs.LocalFileSystem().open_input_file(local)
    system, name = fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
    return system.open_input_file(name)


class _Window:
    """A forward view of a file that holds a block or two of it."""

    def __init__(self, file, start: int):
        self.file, self.base, self.data = file, start, b""
        file.seek(start)

    def more(self) -> bool:
        block = self.file.read(BLOCK)
        self.data += block
        return bool(block)

    def drop(self, upto: int) -> None:
        """Forget what lies before ``upto``, a block at a time."""
        if upto - self.base >= BLOCK:
            self.data, self.base = self.data[upto - self.base:], upto


def _inflate(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The member at offset ``at`` and where it ends; None if it is not a WARC record."""
    unpack, out, size, pos = zlib.decompressobj(31), [], 0, at
    checked = False
    while not unpack.eof:
        if pos - window.base >= len(window.data) and not window.more():
            return None  # cut off
        piece = window.data[pos - window.base: pos - window.base + PIECE]
        try:
            got = unpack.decompress(piece)
        except zlib.error:
            return None
        pos += len(piece) - len(unpack.unused_data)
        out.append(got)
        size += len(got)
        if checked:
            window.drop(pos)
        if not checked and size >= len(VERSION):
            head = b"".join(out)
            if not head.startswith(VERSION):
                return None
            checked = True
    return (b"".join(out), pos) if checked else None


def range_members(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of the members that start in [start, end)."""
    window, at = _Window(file, start), start
    while at < end:
        found = window.data.find(MAGIC, at - window.base)
        if found < 0:
            at = max(at, window.base + len(window.data) - len(MAGIC) + 1)
            window.drop(at)
            if not window.more():
                return
            continue
        at = window.base + found
        if at >= end:
            return
        window.drop(at)
        got = _inflate(window, at)
        if got is None:
            at += 1
            if window.base > at:
                window = _Window(file, at)
            continue
        record, after = got
        yield at, record
        at = after
        window.drop(at)


def parse_record(record: bytes) -> dict:
    """Header fields, payload and its length; the digest is taken anew from a payload that is there."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    block = rest[: int(fields.get("content-length") or 0)]
    kind = fields.get("warc-type")
    payload, length = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        length = len(payload)
        told = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        if kind == "revisit" and told:
            length = int(told[1])
    if kind == "revisit":
        digest, payload = fields.get("warc-payload-digest", "").rpartition(":")[2] or None, None
    else:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return {
        "record_type": kind, "record_id": fields.get("warc-record-id", "").strip("<>") or None,
        "target_uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
        "refers_to_id": fields.get("warc-refers-to", "").strip("<>") or None,
        "payload_digest": digest, "payload_bytes": length, "payload": payload,
    }


RECORD = (
    "path string, offset long, record_type string, record_id string, target_uri string, date string, "
    "refers_to_id string, payload_digest string, payload_bytes long, payload binary"
)


def read_warc(
    spark: SparkSession, path: str, *, split_bytes: int = 64 << 20, payloads: bool = True,
) -> DataFrame:
    """All records of the gzip-per-record archives below ``path``, in any number of files.

    Returns path, offset and the fields of ``parse_record``; ``payloads=False``
    leaves payloads null and saves their way out of the task. Members that do
    not decode as WARC records (damaged or cut off ones too) are passed over.
    A file without records, or no file, gives no rows.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select("path", "length").filter("length > 0")
    )
    ranges = files.select(
        "path", "length",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start"),
    )
    # One task per range: rows this small would otherwise be merged into a few tasks.
    ranges = ranges.repartition(max(1, ranges.count()))
    names = [x.split()[0] for x in RECORD.split(", ")]

    def scan(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            (n, pa.binary() if n == "payload" else pa.int64() if n in ("offset", "payload_bytes") else pa.string())
            for n in names
        ])
        for batch in stream:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                rows, held = [], 0
                with _open(name) as file:
                    for offset, record in range_members(file, start, start + split_bytes):
                        row = parse_record(record) | {"path": name, "offset": offset}
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 500
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return ranges.mapInArrow(scan, RECORD)


def page_records(records: DataFrame) -> DataFrame:
    """The page columns of records that ``write_warc`` made."""
    def page(ref: str) -> Column:
        return F.expr(f"try_cast(substring({ref}, {len(PAGE_ID) + 1}) AS bigint)")

    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to_id").alias("refers_to"),
    )
