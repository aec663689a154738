"""WARC archives: writing with deduplication, reading with segment reassembly.

Writing: payloads are grouped by SHA-1; of equal ones the row with the largest
id becomes the response record and the others revisit records that refer to
it.  A response block is an HTTP message in chunked transfer framing; beyond
``segment_bytes`` it is continued in further records (WARC 1.1, section 7).
Every record is a gzip member of its own.

Reading: files are parsed record by record, the records of an origin grouped
and ordered by segment number, the whole length verified, the transfer framing
decoded and the payload's digest compared with the header's.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import folder, kept, open_file, write_file

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
_DATE = "2020-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where it should")
        out.append(body[at:at + size])
        at += size + 2


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *headers, ("WARC-Date", _DATE), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return gzip.compress(text.encode() + block + b"\r\n\r\n", 6, mtime=0)


def record_id(page: int | None, row: str) -> str:
    return f"<urn:blogweave:page:{'' if page is None else page}:{row}>"


def _page_of(record: str | None) -> int | None:
    number = record.split(":")[3] if record else ""
    return int(number) if number else None


def records(page: int | None, row: str, url: str | None, payload: bytes, digest: str, refers: str | None,
            segment_bytes: int) -> Iterator[bytes]:
    """The records of one page."""
    own = record_id(page, row)
    uri = re.sub(r"[\x00-\x20\x7f<>]", lambda m: "%%%02X" % ord(m[0]), url) if url else "urn:blogweave:no-url"
    common = [("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        yield _record("revisit", [("WARC-Record-ID", own), *common, ("WARC-Profile", _REVISIT), ("WARC-Refers-To", refers)], block)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        yield _record("response", [("WARC-Record-ID", own), *common], block)
        return
    yield _record("response", [("WARC-Record-ID", own), *common, ("WARC-Segment-Number", "1")], block[:segment_bytes])
    for number, i in enumerate(range(segment_bytes, len(block), segment_bytes), 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if i + segment_bytes >= len(block) else []
        yield _record("continuation", [("WARC-Record-ID", f"{own[:-1]}:segment-{number}>"), ("WARC-Target-URI", uri), ("WARC-Segment-Origin-ID", own),
                                       ("WARC-Segment-Number", str(number)), *last], block[i:i + segment_bytes])


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an uncompressed stream."""
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a record ends early")
        yield headers, block


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
                   row: Column | None = None, min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One gzipped WARC file per task below ``path``; a row per file: path, records.

    ``row`` names a row for good (without spaces, ":" or ">"); it tells rows
    that share an id and a payload apart, of which one only is the response.
    By default it is the row's place in Spark's reading of ``pages``, which
    must then be the same whenever it is read.  Payloads below ``min_bytes``
    are always responses.
    """
    source = pages.select(
        F.col(key).cast("long").alias("page"), F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8").alias("payload"),
        (row if row is not None else F.monotonically_increasing_id()).cast("string").alias("row"))
    known = source.select("page", "row", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("size"))
    first = (known.filter(F.col("size") >= min_bytes).groupBy("sha").agg(F.max(F.struct("page", "row")).alias("top")))
    same = F.col("page").eqNullSafe(F.col("top.page")) & (F.col("row") == F.col("top.row"))
    dealt = (source.withColumn("sha", F.sha1("payload")).join(first, "sha", "left")
             .select("page", "row", "url", "payload", "sha", F.col("top.page").alias("to_page"),
                     F.when(F.col("top").isNull() | same, F.lit(None)).otherwise(F.col("top.row")).alias("to_row")))

    def run(batches):
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        target, n = f"{path}/part-{TaskContext.get().partitionId():06d}.warc.gz", 0

        def write(out):
            nonlocal n
            out.write(_record("warcinfo", [("WARC-Record-ID", f"<urn:blogweave:info:{target.rsplit('/', 1)[1]}>"),
                                           ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
            for batch in (b for part in ((first,), batches) for b in part):
                for page, name, at, payload, sha, to_page, to_row in zip(*[c.to_pylist() for c in batch.columns]):
                    digest = base64.b32encode(bytes.fromhex(sha)).decode()
                    refers = record_id(to_page, to_row) if to_row is not None else None
                    for record in records(page, name, at, payload, digest, refers, segment_bytes):
                        out.write(record)
                        n += 1

        write_file(target, write)
        yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([n], pa.int64())], names=["path", "records"])

    return kept(dealt.mapInArrow(run, "path string, records long"), "warc-files")


def _payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if re.search(rb"(?i)\r\ntransfer-encoding: *chunked", head) else body


_SEGMENT = pa.struct([("number", pa.int64()), ("block", pa.binary()), ("total", pa.int64())])
_PARSED = pa.schema([("origin", pa.string()), ("record_type", pa.string()), ("digest", pa.string()), ("refers", pa.string()),
                     ("bytes", pa.int64()), ("error", pa.string()), ("segment", _SEGMENT)])


def _decoded(block: bytes, digest: str | None) -> tuple[int | None, str | None, str | None]:
    """Payload bytes, its digest, and what is wrong with it."""
    try:
        payload = _payload(block)
    except ValueError as e:
        return None, None, f"transfer framing: {e}"
    own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return len(payload), own, None if digest in (None, f"sha1:{own}") else "payload differs from its digest"


def read_archives(files: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, error
    of each response and revisit record of the files (column path).

    A revisit's payload is described by its own headers.  ``error`` tells what
    is wrong with a record: a missing segment, a wrong total length, broken
    transfer framing, another digest; it is null for a whole record.
    """
    def parsed(batches):
        rows: list[tuple] = []

        def batch():
            columns = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARSED)], schema=_PARSED)

        for b in batches:
            for path in b.column(0).to_pylist():
                with open_file(path) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    held = 0
                    for headers, block in parse(stream):
                        kind, own, digest = headers["warc-type"], headers["warc-record-id"], headers.get("warc-payload-digest")
                        number = headers.get("warc-segment-number")
                        if kind == "revisit":
                            size = re.search(rb"(?i)\r\ncontent-length: *(\d+)", block)
                            rows.append((own, kind, digest, headers.get("warc-refers-to"), int(size[1]) if size else None, None, None))
                        elif kind in ("response", "continuation") and number:
                            total = headers.get("warc-segment-total-length")
                            rows.append((headers.get("warc-segment-origin-id", own), None if kind == "continuation" else kind, digest, None, None, None,
                                         {"number": int(number), "block": block, "total": int(total) if total else None}))
                            held += len(block)
                        elif kind == "response":
                            size, seen, error = _decoded(block, digest)
                            rows.append((own, kind, f"sha1:{seen}" if seen else digest, None, size, error, None))
                        if len(rows) >= 5000 or held > 8 << 20:
                            held = 0
                            yield batch()
        if rows:
            yield batch()

    n = max(1, files.count())
    found = files.select("path").repartition(n, "path").mapInArrow(
        parsed, "origin string, record_type string, digest string, refers string, bytes long, error string, "
                "segment struct<number:long, block:binary, total:long>")
    # the segments of one record: a group is as large as one page
    whole = found.groupBy("origin").agg(
        *[F.max(c).alias(c) for c in ("record_type", "digest", "refers", "bytes", "error")], F.collect_list("segment").alias("segments"))

    def assembled(batches):
        for b in batches:
            out = {k: b.column(i).to_pylist() for i, k in enumerate(("origin", "record_type", "digest", "refers", "bytes", "error"))}
            sizes = np.diff(np.asarray(b.column(6).offsets))
            for i in np.flatnonzero(sizes):
                parts = sorted(b.column(6)[int(i)].as_py(), key=lambda s: s["number"])
                block = b"".join(s["block"] for s in parts)
                if [s["number"] for s in parts] != list(range(1, len(parts) + 1)) or parts[-1]["total"] is None:
                    out["error"][i] = "segments are missing"
                elif parts[-1]["total"] != len(block):
                    out["error"][i] = "total length differs"
                else:
                    out["bytes"][i], seen, out["error"][i] = _decoded(block, out["digest"][i])
                    out["digest"][i] = f"sha1:{seen}" if seen else out["digest"][i]
            yield pa.RecordBatch.from_arrays([
                pa.array([_page_of(x) for x in out["origin"]], pa.int64()), pa.array(out["bytes"], pa.int64()),
                pa.array([x and x.removeprefix("sha1:") for x in out["digest"]], pa.string()), pa.array(out["record_type"], pa.string()),
                pa.array([_page_of(x) for x in out["refers"]], pa.int64()), pa.array(out["error"], pa.string())],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error"])

    return whole.mapInArrow(assembled, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, error string")


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` and read the archives back: a row per row.  A null html
    is an empty payload, a null url is written as a name of its own, a null
    page_id loses against any other; of rows that repeat an id and a payload
    one is the response; other columns are ignored; an empty table gives no
    file and no row."""
    return read_archives(write_archives(pages, folder(pages.sparkSession, "warc"), **options))


# DuckDB SQL of the round trip over ``pages`` (its columns but record positions are content, so that no archive is needed).
SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS sha,
             ('0x' || sha1(payload)) AS hex FROM p),
bits AS (SELECT *, list_aggregate([CASE substr(sha, CAST(i AS INT), 1)
        WHEN '0' THEN '0000' WHEN '1' THEN '0001' WHEN '2' THEN '0010' WHEN '3' THEN '0011'
        WHEN '4' THEN '0100' WHEN '5' THEN '0101' WHEN '6' THEN '0110' WHEN '7' THEN '0111'
        WHEN '8' THEN '1000' WHEN '9' THEN '1001' WHEN 'a' THEN '1010' WHEN 'b' THEN '1011'
        WHEN 'c' THEN '1100' WHEN 'd' THEN '1101' WHEN 'e' THEN '1110' ELSE '1111' END FOR i IN range(1, 41)], 'string_agg', '') AS b FROM d),
w AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS top FROM bits)
SELECT page_id, payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + 16 * (ascii(substr(b, CAST(5 * i + 1 AS INT), 1)) - 48)
         + 8 * (ascii(substr(b, CAST(5 * i + 2 AS INT), 1)) - 48) + 4 * (ascii(substr(b, CAST(5 * i + 3 AS INT), 1)) - 48)
         + 2 * (ascii(substr(b, CAST(5 * i + 4 AS INT), 1)) - 48) + (ascii(substr(b, CAST(5 * i + 5 AS INT), 1)) - 48) AS INT), 1)
         FOR i IN range(0, 32)], 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to, CAST(NULL AS VARCHAR) AS error
FROM w"""
