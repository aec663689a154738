import base64
import gzip
import hashlib
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blogweave.llm import warc
from blogweave.llm.store import folder


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 50))
def test_transfer_framing(payload, size):
    assert warc.unchunked(warc.chunked(payload, size)) == payload


def test_broken_framing():
    for body in (b"5\r\nabc", b"3\r\nabcXX0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(body)


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=2000), st.integers(150, 400))
def test_segments(payload, size):
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    data = b"".join(warc.records(7, "r", "http://a/ b\n", payload, digest, None, size))
    got = list(warc.parse(gzip.GzipFile(fileobj=io.BytesIO(data))))
    block = b"".join(b for _, b in got)
    assert all(len(b) <= size for _, b in got) and warc._payload(block) == payload
    if len(got) > 1:
        assert [h["warc-segment-number"] for h, _ in got] == [str(i + 1) for i in range(len(got))]
        assert [h.get("warc-segment-total-length") for h, _ in got][-1] == str(len(block))
        assert {h["warc-type"] for h, _ in got[1:]} == {"continuation"} and got[0][0]["warc-type"] == "response"


def brute(rows, min_bytes=0):
    top = {}
    for k, html in rows:
        p = (html or "").encode()
        top.setdefault(p, []).append(k)
    out = []
    for p, keys in top.items():
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        keys = sorted(keys, key=lambda k: -1 if k is None else k)
        for i, k in enumerate(keys):
            first = i == len(keys) - 1 or len(p) < min_bytes
            out.append((k, len(p), digest, "response" if first else "revisit", None if first else keys[-1], None))
    return sorted(out, key=repr)


def test_round_trip_of_odd_pages(spark):
    rows = [(1, "http://a/", "x" * 50_000), (2, None, "x" * 50_000), (3, "u", None), (4, "u", ""), (None, "u", "same"), (5, "u", "same"),
            (5, "u", "same"), (6, "u\r\nWARC-Type: x", "é漢\r\n\r\nWARC/1.1\r\n"), (7, "u", "y" * 300_000), (None, None, None)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, record_type string")
    pages = pages.repartition(3, "page_id")
    for options in ({}, {"min_bytes": 100}, {"segment_bytes": 500}):
        got = sorted((tuple(r) for r in warc.archive_round_trip(pages, **options).collect()), key=repr)
        assert got == brute([(k, h) for k, _, h in rows], options.get("min_bytes", 0))
    assert warc.archive_round_trip(pages.limit(0)).collect() == []


def test_a_lost_segment_is_told(spark, tmp_path):
    digest = base64.b32encode(hashlib.sha1(b"z" * 900).digest()).decode()
    parts = list(warc.records(1, "r", "u", b"z" * 900, digest, None, 300))
    whole = list(warc.records(2, "r", "u", b"z" * 900, "A" * 32, None, 300))
    (tmp_path / "a").write_bytes(b"".join(parts[:1] + parts[2:] + whole[:-1]))
    (tmp_path / "b").write_bytes(whole[-1])             # continued in another file
    files = spark.createDataFrame([(str(tmp_path / x), 1) for x in "ab"], "path string, records long")
    got = {r.page_id: r.error for r in warc.read_archives(files).collect()}
    assert got == {1: "segments are missing", 2: "payload differs from its digest"}


def test_files_are_written_once(spark):
    pages = spark.range(50).selectExpr("id AS page_id", "'u' AS url", "repeat('a', int(id)) AS html")
    files = warc.write_archives(pages, folder(spark, "warc-test"))
    assert files.agg({"records": "sum"}).first()[0] >= 50
