import gzip
import hashlib
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sensorlake.llm import op10_warc as op

from tests.llm.conftest import SF, same

BIG = "<p>é" + "x" * 1200
#: A payload that hardly shrinks, so its record has many chunks.
DENSE = "".join(hashlib.sha256(str(k).encode()).hexdigest() for k in range(8000))
ROWS = [(1, "http://a", BIG, 1), (2, "http://b", BIG, 1), (3, None, None, 1), (4, "u\r\nWARC/1.1\r\n", "", 1), (5, "u", "small", 1),
        (6, "u", "small", 1), (None, "u", BIG, 1), (7, "u", "line\r\n\r\nWARC/1.1\r\n\r\n" * 60, 1), (8, "u", DENSE, 1),
        (9, "u", "z" * 999, 1), (10, "u", "z" * 999, 1), (11, "u", "é" * 500, 1), (12, "u", "é" * 500, 1), (12, "u", "é" * 500, 1)]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string, record int")


def brute(rows):
    out = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        equal = [p for p, _, h, _ in rows if (h or "").encode() == data and p is not None]
        newest = max(equal, default=None) if len(data) >= 1000 else None
        other = newest is not None and newest != page
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if other else "response", newest if other else None))
    return sorted(out, key=repr)


def test_supplied_pages(spark, duck):
    same(op.query(spark, SF), duck, op.ORACLE)


@pytest.mark.parametrize("chunk_bytes", [7, 400, 1 << 20])
def test_records_come_back(pages, chunk_bytes):
    chunks = op.write_archives(pages, chunk_bytes=chunk_bytes)
    got = op.read_archives(chunks).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=repr) == brute(ROWS)
    assert all(r.verified == (r.record_type == "response") for r in got)
    if chunk_bytes == 7:
        assert chunks.agg(F.max("chunk")).first()[0] > 3


def test_digests_grow_with_the_chunks(pages):
    rows = op.write_archives(pages.filter("page_id = 8"), chunk_bytes=16).orderBy("chunk").collect()
    assert [r.chunk for r in rows] == list(range(len(rows))) and [r.last for r in rows] == [False] * (len(rows) - 1) + [True]
    assert rows[-1].digest == hashlib.sha1(DENSE.encode()).hexdigest()


def test_an_archive_is_a_warc_file(pages):
    chunks = op.write_archives(pages.coalesce(1), chunk_bytes=64)
    data, seen = b"", []
    for a in [r.archive for r in chunks.select("archive").distinct().collect()]:
        data = gzip.decompress(b"".join(op.archive_bytes(chunks, a)))
        while data:  # record by record, by the lengths that the headers state
            head, rest = data.split(b"\r\n\r\n", 1)
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            length = int(fields["Content-Length"])
            block, end, data = rest[:length], rest[length:length + 4], rest[length + 4:]
            assert head.startswith(b"WARC/1.1\r\n") and end == b"\r\n\r\n"
            payload = block.split(b"\r\n\r\n", 1)[1]
            if fields["WARC-Type"] == "response":
                assert fields["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(payload).hexdigest()
            else:
                assert payload == b"" and fields["WARC-Refers-To"]
            assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"])
            seen.append((fields["WARC-Type"], fields["WARC-Record-ID"], fields.get("WARC-Refers-To")))
    assert len(seen) == len(ROWS)
    # records that nothing refers to have ids of their own, and revisits name a response that is there
    responses = [i for kind, i, _ in seen if kind == "response"]
    assert {to for kind, _, to in seen if kind == "revisit"} <= set(responses)
    shared = [i for _, i, _ in seen if ":" not in i.removeprefix("<urn:page:")]
    assert len({i for _, i, _ in seen}) == len(seen) - len(shared) + len(set(shared))
    assert set(shared) <= {f"<urn:page:{k}>" for k in (2, 12)}


def test_records_are_dated_alike(pages):
    when = datetime(2024, 2, 29, 12, 30, tzinfo=timezone(timedelta(hours=2)))
    chunks = op.write_archives(pages, written=when)
    for a in [r.archive for r in chunks.select("archive").distinct().collect()]:
        data = gzip.decompress(b"".join(op.archive_bytes(chunks, a)))
        assert set(re.findall(rb"WARC-Date: (.*?)\r\n", data)) == {b"2024-02-29T10:30:00Z"}


def test_damage_is_noticed(pages):
    chunks = op.write_archives(pages.filter("page_id = 8"), chunk_bytes=16)
    with pytest.raises(Exception, match="out of order|damaged|no last chunk|incorrect"):
        op.read_archives(chunks.filter("chunk <> 2")).collect()


def test_empty_table(pages):
    assert op.read_archives(op.write_archives(pages.limit(0))).count() == 0


def test_a_hot_payload_is_spread(spark):
    rows = [(k, "u", BIG, 1) for k in range(300)] + [(1000 + k, "u", f"{k}" * 500, 1) for k in range(600)]
    got = op.read_archives(op.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string, record int")))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()], key=repr) \
        == brute(rows)
