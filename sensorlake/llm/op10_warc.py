"""WARC output and input over a chunked record table.

``write_archives`` turns pages into WARC/1.1 records and stores each record as rows
(record, chunk number, bytes, digest so far) of at most ``chunk_bytes``; the rows of
an archive, end to end in order, are a valid WARC file of gzip members, one for each
record. A payload is cut, hashed and compressed piece by piece, never held twice.
``read_archives`` streams the rows of each record through one decompressor, parses
the headers, hashes the payload as it passes and compares it with the digest written.

Of records with equal payloads of at least ``least`` bytes, that with the largest
page_id is a response and the others are revisits of it, without a payload.

Cases: null html is an empty payload; payloads below ``least`` bytes are all
responses; rows that share payload and the largest page_id are all responses, and the
only records that share a record id (revisits name it); a null page_id is smaller than
any other and comes back null; an empty table gives no archive rows; other columns than
page_id, url and html are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import copies_joined, salted_max, stored, table

LEAST = 1000
CHUNK_BYTES = 1 << 20
CHUNKS = "archive int, record long, chunk int, last boolean, digest string, data binary"
RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, verified boolean")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def typed(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Add digest, size and, for revisits, the page referred to."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"),
                        F.octet_length(html).cast("long").alias("size"))
    slim = rows.select("page_id", "digest", "size").filter(F.col("size") >= least)
    newest = salted_max(slim, ["digest", "size"], [F.max("page_id").alias("newest"), F.count("*").alias("n")],
                        [F.max("newest").alias("newest"), F.sum("n").alias("n")], spread="page_id") \
        .filter("n > 1").drop("n")
    joined = copies_joined(rows, ["digest", "size"], newest, spread="page_id")
    other = F.col("newest").isNotNull() & ~F.col("newest").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "html", "digest", "size", F.when(other, F.col("newest")).alias("refers_to"),
                         (F.col("newest").isNotNull() & ~other).alias("referred"))


def _one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _record_id(page_id: int | None, place: str | None = None) -> str:
    """``<urn:page:7>`` of a record that others may refer to, else with its place in the archives."""
    return f"<urn:page:{'none' if page_id is None else page_id}{':' + place if place else ''}>"


def _page_of(record_id: str | None) -> int | None:
    page = (record_id or "<urn:page:none>").removeprefix("<urn:page:").removesuffix(">").split(":")[0]
    return None if page == "none" else int(page)


def _headers(row: dict, place: str, date: str) -> tuple[bytes, bytes]:
    """The record's header and the HTTP header that its block begins with."""
    url, digest, size, refers_to = (row[x] for x in ("url", "digest", "size", "refers_to"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    lines += [f"WARC-Record-ID: {_record_id(row['page_id'], None if row['referred'] else place)}", f"WARC-Date: {date}"]
    lines += [] if url is None else [f"WARC-Target-URI: {_one_line(url)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    length = len(http) + (size if refers_to is None else 0)
    lines += [f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode(), http


def _pieces(text: pa.StringScalar, step: int) -> Iterator[memoryview]:
    """The UTF-8 bytes of an Arrow text, without a copy of the whole."""
    view = memoryview(text.as_buffer())
    for at in range(0, len(view), step):
        yield view[at:at + step]


def write_archives(pages: DataFrame, least: int = LEAST, chunk_bytes: int = CHUNK_BYTES,
                   written: datetime | None = None) -> DataFrame:
    """Store the chunk table of all pages' records, dated ``written`` (now); returns it as read back."""
    date = (written or datetime.now(UTC)).astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, record = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            html = batch.column("html")
            slim = batch.select(["page_id", "url", "digest", "size", "refers_to", "referred"]).to_pylist()
            for k, row in enumerate(slim):
                for n, last, digest, data in _record(row, html[k], chunk_bytes, f"{archive}.{record}", date):
                    rows.append((archive, record, n, last, digest, data))
                    held += len(data) + 64
                    if held >= 4 * chunk_bytes:
                        yield _chunk_batch(rows)
                        rows, held = [], 0
                record += 1
        if rows:
            yield _chunk_batch(rows)

    return stored(typed(pages, least).mapInArrow(write, CHUNKS), "warc")


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)],
                                      names=["archive", "record", "chunk", "last", "digest", "data"])


def _record(row: dict, html: pa.StringScalar, step: int, place: str, date: str) -> Iterator[tuple[int, bool, str, bytes]]:
    """(chunk number, last, SHA-1 of the payload so far, bytes of the gzip member)."""
    header, http = _headers(row, place, date)
    squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
    sha, n = hashlib.sha1(), 0
    out = squeeze.compress(header) + squeeze.compress(http)
    if row["refers_to"] is None:
        for piece in _pieces(html, step):
            sha.update(piece)
            out += squeeze.compress(piece)
            if len(out) >= step:
                yield n, False, sha.hexdigest(), out
                n, out = n + 1, b""
        if sha.hexdigest() != row["digest"]:
            raise ValueError(f"payload of page {row['page_id']} differs from its digest")
    out += squeeze.compress(b"\r\n\r\n") + squeeze.flush()
    yield n, True, sha.hexdigest(), out


class _Reader:
    """One record, fed with the chunks of its gzip member in order."""

    def __init__(self) -> None:
        self.plain = zlib.decompressobj(31)
        self.head = b""
        self.fields: dict[str, str] | None = None
        self.sha = hashlib.sha1()
        self.left = 0
        self.tail = b""

    def feed(self, data: bytes, step: int = CHUNK_BYTES) -> None:
        while data:
            self._take(self.plain.decompress(data, step))
            data = self.plain.unconsumed_tail

    def _take(self, data: bytes) -> None:
        if self.fields is None:
            self.head += data
            if self.head.count(b"\r\n\r\n") < 2:
                return
            warc, http, data = self.head.split(b"\r\n\r\n", 2)
            lines = warc.decode().split("\r\n")
            if lines[0] != "WARC/1.1":
                raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
            self.fields = dict(x.split(": ", 1) for x in lines[1:])
            self.size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
            self.left = int(self.fields["Content-Length"]) - len(http) - 4
        take = data[:self.left]
        self.sha.update(take)
        self.left -= len(take)
        self.tail += data[len(take):]

    def row(self) -> tuple:
        f = self.fields or {}
        digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = f["WARC-Type"]
        whole = self.left == 0 and self.tail == b"\r\n\r\n" and self.plain.eof
        if not whole or (kind == "response" and digest != self.sha.hexdigest()):
            raise ValueError(f"damaged record {f.get('WARC-Record-ID')}")
        return (_page_of(f["WARC-Record-ID"]), f.get("WARC-Target-URI"), kind, _page_of(f.get("WARC-Refers-To")),
                self.size, digest, kind == "response")


def read_archives(chunks: DataFrame) -> DataFrame:
    """One row per record. A record of one chunk is read where it lies; the chunks of a longer one
    meet in one task in order, one chunk at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reader, rows = None, _Reader(), []
        for batch in batches:
            data = batch.column("data")
            slim = batch.select(["archive", "record", "chunk", "last"]).to_pylist()
            for k, c in enumerate(slim):
                if c["chunk"] == 0:
                    now, reader, n = (c["archive"], c["record"]), _Reader(), 0
                if (c["archive"], c["record"]) != now or c["chunk"] != n:
                    raise ValueError(f"chunk {c} out of order")
                reader.feed(data[k].as_py())
                n += 1
                if c["last"]:
                    rows.append(reader.row())
                    now = None
            if len(rows) >= 5000:
                yield _record_batch(rows)
                rows = []
        if now is not None:
            raise ValueError(f"record {now} has no last chunk")
        if rows:
            yield _record_batch(rows)

    rows = chunks.select("archive", "record", "chunk", "last", "data")
    alone = (F.col("chunk") == 0) & F.col("last")
    long = rows.filter(~alone).repartition("archive", "record").sortWithinPartitions("archive", "record", "chunk")
    return rows.filter(alone).mapInArrow(read, RECORDS).unionByName(long.mapInArrow(read, RECORDS))


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    names = [x.split()[0] for x in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], names=names)


def archive_bytes(chunks: DataFrame, archive: int) -> Iterator[bytes]:
    """The bytes of one archive file (.warc.gz) in order, a chunk at a time."""
    rows = chunks.filter(F.col("archive") == archive).orderBy("record", "chunk").select("data")
    for row in rows.toLocalIterator():
        yield bytes(row.data)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_archives(write_archives(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
             max(page_id) OVER (PARTITION BY h) AS newest FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM d
"""
