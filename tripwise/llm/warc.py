"""Monolithic gzip normaliser for WARC archives.

Crawls often arrive as one gzip stream over a whole archive: no record can be read
without inflating all before it.  ``normalise`` inflates such a stream once, in
pieces of bounded size, writes every record as a gzip member of its own and a
sidecar index (offset and length of each member), so that ``read_records`` seeks.

Archives are rows (archive, data) of a Parquet table in the shared folder, so
Spark's commit protocol covers lost executors.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.llm.common import written

#: An archive is closed once its records pass so many bytes before compression.
ARCHIVE_BYTES = 8 << 20
#: Payloads below this size are always stored.
MIN_REVISIT_BYTES = 1000
_PIECE = 1 << 18
_GZIP = 16 + zlib.MAX_WBITS


def assign_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to) of every page row.

    payload is the html in UTF-8 (null: empty).  Of equal payloads of at least
    ``min_bytes`` that of the largest page_id is the response; refers_to names it in
    the other rows and is null elsewhere.  Null ids are smaller than any id; rows
    that repeat the response's id are responses too.  Digests and the largest id are
    aggregated before the join; only groups of several ids are joined.
    """
    p = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn(
        "payload_digest", F.sha1("payload"))
    groups = (p.filter(F.col("payload_bytes") >= min_bytes)
              .groupBy("payload_digest").agg(F.max("page_id").alias("last_id"), F.count("*").alias("n"))
              .filter("n > 1 AND last_id IS NOT NULL").select("payload_digest", "last_id"))
    joined = p.join(groups, "payload_digest", "left")
    other = F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id"))
    return joined.select("page_id", "url", "payload", "payload_bytes", "payload_digest",
                         F.when(other, F.col("last_id")).alias("refers_to"))


def _token(value: str | None) -> str:
    """A header value on one line (percent-encoded control characters)."""
    return re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", value or "")


def warc_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has no block and keeps the payload's length in a header."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if kind == "response" else b""
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {_token(url)}", "Content-Type: text/html; charset=utf-8",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_header(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:] if line)


def split_records(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The records of an inflated stream that arrives in pieces; holds one record and one piece."""
    buffer, need = bytearray(), None
    for piece in pieces:
        buffer += piece
        while True:
            if need is None:
                end = buffer.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(parse_header(bytes(buffer[:end]))["Content-Length"]) + 4
            if len(buffer) < need:
                break
            yield bytes(buffer[:need])
            del buffer[:need]
            need = None
    if buffer:
        raise ValueError("the stream ends within a record")


def inflate(data: bytes) -> Iterator[bytes]:
    """A gzip stream of one or more members, inflated in pieces of at most 256 KB."""
    view, d = memoryview(data), zlib.decompressobj(_GZIP)
    at = 0
    while at < len(view):
        feed = view[at:at + _PIECE]
        at += len(feed)
        while feed:
            out = d.decompress(feed, _PIECE)
            if out:
                yield out
            if d.eof:
                feed = d.unused_data
                d = zlib.decompressobj(_GZIP)
                if not feed and at >= len(view):
                    return
                continue
            feed = d.unconsumed_tail
    while not d.eof:  # what the window still holds
        out = d.decompress(b"", _PIECE) if not d.unconsumed_tail else d.decompress(d.unconsumed_tail, _PIECE)
        if not out:
            raise ValueError("truncated gzip stream")
        yield out


def normalise(data: bytes, level: int = 6) -> tuple[bytes, list[tuple[int, int]]]:
    """Per-record members of a gzip stream, and each member's (offset, length)."""
    out, index = bytearray(), []
    for record in split_records(inflate(data)):
        c = zlib.compressobj(level, zlib.DEFLATED, _GZIP)
        member = c.compress(record) + c.flush()
        index.append((len(out), len(member)))
        out += member
    return bytes(out), index


def write_monolithic(assigned: DataFrame, archive_bytes: int = ARCHIVE_BYTES, level: int = 1) -> DataFrame:
    """(archive, data): the records as gzip streams over whole archives, written to the shared folder."""

    def pack(batches):
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        c, data, size = None, bytearray(), 0

        def closed():
            nonlocal c, data, size, n
            done = bytes(data + c.flush())
            row = pa.RecordBatch.from_pydict({"archive": [f"{part:06d}-{n:06d}"], "data": [done]},
                                             schema=pa.schema([("archive", pa.string()), ("data", pa.binary())]))
            c, data, size, n = None, bytearray(), 0, n + 1
            return row

        for b in batches:
            ids, urls, payloads, digests, refers = (b.column(i) for i in range(5))
            for i in range(b.num_rows):
                record = warc_record(ids[i].as_py(), urls[i].as_py(), payloads[i].as_py(), digests[i].as_py(),
                                     refers[i].as_py())
                c = c or zlib.compressobj(level, zlib.DEFLATED, _GZIP)
                data += c.compress(record)
                size += len(record)
                if size >= archive_bytes:
                    yield closed()
        if c:
            yield closed()

    cols = assigned.select("page_id", "url", "payload", "payload_digest", "refers_to")
    return written(cols.mapInArrow(pack, "archive string, data binary"), "warc-monolithic")


def normalise_archives(archives: DataFrame) -> DataFrame:
    """(archive, data, offsets, lengths): per-record members with the sidecar index, written."""

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                data, index = normalise(b.column(1)[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, 1), pa.array([data], pa.binary()),
                     pa.array([[x[0] for x in index]], pa.list_(pa.int64())),
                     pa.array([[x[1] for x in index]], pa.list_(pa.int64()))],
                    names=["archive", "data", "offsets", "lengths"])

    return written(archives.select("archive", "data").mapInArrow(
        run, "archive string, data binary, offsets array<long>, lengths array<long>"), "warc-records")


def read_records(archives: DataFrame) -> DataFrame:
    """Every record of normalised archives, each inflated alone at its offset of the index.

    payload_bytes and payload_digest of a response are computed from the stored
    block (and must equal its headers); those of a revisit are its headers'.
    """
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "url string, archive string, member_offset long, member_length long")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    arrow = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")])

    def page(urn: str | None) -> int | None:
        number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                archive, data = b.column(0)[i].as_py(), memoryview(b.column(1)[i].as_buffer())
                rows: list[tuple] = []
                for at, length in zip(b.column(2)[i].as_py(), b.column(3)[i].as_py(), strict=True):
                    record = zlib.decompress(data[at:at + length], _GZIP)
                    end = record.index(b"\r\n\r\n")
                    h, block = parse_header(record[:end]), record[end + 4:-4]
                    digest, size = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"])
                    if h["WARC-Type"] == "response":
                        if (hashlib.sha1(block).hexdigest(), len(block)) != (digest, size):
                            raise ValueError(f"damaged record at {at} of {archive}")
                    rows.append((page(h["WARC-Record-ID"]), size, digest, h["WARC-Type"],
                                 page(h.get("WARC-Refers-To")), h["WARC-Target-URI"], archive, at, length))
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows, strict=True), strict=True)), schema=arrow)

    return archives.select("archive", "data", "offsets", "lengths").mapInArrow(run, schema)


def pages_to_warc(pages: DataFrame) -> DataFrame:
    """Write all pages as monolithic archives, normalise them, and read every record back."""
    return read_records(normalise_archives(write_monolithic(assign_revisits(pages))))
