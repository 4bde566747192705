"""Chunked WARC records (3)."""

import gzip
import hashlib
import glob
import re

from tsquality.llm import warc

from edge import stored

BIG = "x" * 1200


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows],
                                 "page_id BIGINT, url STRING, html STRING, sha1 STRING, row INT")


ROWS = [(1, "http://a/", BIG), (2, None, BIG), (9, "http://b/\r\nX: y", BIG), (3, "u", "short"), (4, "u", "short"), (5, "u", None),
        (6, "u", ""), (7, "u", "é" * 70_000 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "日\n" * 90_000),
        (8, "u", "\r\n"), (9, "v", BIG), (None, "n", BIG), (None, "n", "y" * 2000), (12, "u", "\n" * 5000), (13, "u", "\n" * 5000),
        (14, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (15, "u", "é" * 499), (16, "u", "é" * 499), (17, "u", "é" * 500),
        (18, "u", "é" * 500)]


def brute(rows):
    top = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            top[b] = max(top.get(b, i), i)
    for i, _, h in rows:
        b = (h or "").encode()
        again = b in top and top[b] != i
        yield i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top[b] if again else None


def key(r):
    return tuple((x is None, x) for x in r)


def test_round_trip(spark, tmp):
    got = [tuple(r) for r in warc.archived(stored(pages(spark, ROWS), tmp, "pages")).collect()]
    assert sorted(got, key=key) == sorted(brute(ROWS), key=key)


def test_payloads_and_segments(spark, tmp):
    path = f"{tmp}/warc"
    warc.write_archives(stored(pages(spark, ROWS), tmp, "pages"), path, chunk_bytes=1000)
    got = warc.read_archives(spark, path, with_body=True).collect()
    payload, ends = {}, {}
    for r in sorted(got, key=lambda r: (r.record_row, r.segment)):
        payload[r.record_row] = payload.get(r.record_row, "") + r.body
        ends[r.record_row] = r
        if r.kind != "revisit":  # digests run along with the chunks
            raw = payload[r.record_row].encode()
            assert (r.bytes, r.sha1) == (len(raw), hashlib.sha1(raw).hexdigest())
    assert max(r.segment for r in got) > 200
    whole = sorted((ends[k].record_id, p) for k, p in payload.items() if ends[k].kind != "revisit" and ends[k].record_id is not None)
    assert whole == sorted((i, h or "") for (i, _, h), (_, _, _, kind, _) in zip(ROWS, brute(ROWS)) if kind == "response" and i is not None)


def test_files_are_warc(spark, tmp):
    path = f"{tmp}/warc"
    warc.write_archives(stored(pages(spark, ROWS[:6]), tmp, "pages"), path)
    n = 0
    for f in glob.glob(f"{path}/part-*.gz"):
        raw = gzip.open(f).read()
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
            size = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
            assert rest[size:size + 4] == b"\r\n\r\n"
            raw, n = rest[size + 4:], n + 1
    assert n == 6


def test_no_pages(spark, tmp):
    assert warc.archived(stored(pages(spark, []), tmp, "pages")).collect() == []


def test_cuts_are_at_characters():
    import numpy as np
    text = "aé日\U0001F600" * 50
    raw = np.frombuffer(text.encode(), np.uint8)
    for size in (1, 4, 5, 7, 64, 10_000):
        parts = [raw[a:z].tobytes() for a, z in warc.cuts(raw, size)]
        assert b"".join(parts) == text.encode() and all(p.decode() for p in parts) and max(map(len, parts)) <= max(4, size)
    assert list(warc.cuts(raw[:0], 10)) == [(0, 0)]


def test_a_very_long_payload_is_never_whole_in_a_row(spark, tmp):
    """40 MB without a line break: chunk rows and the archive's lines are bounded, time grows with the length."""
    text = "0123456789abcde\u00e9" * 2_500_000
    rows = [(1, "u", text), (2, "u", text), (3, "u", "short")]
    import os
    import pyarrow as pa
    import pyarrow.parquet as pq
    os.makedirs(f"{tmp}/pages.parquet")
    for k, r in enumerate(rows):  # by another writer, as the payloads are large for this test's heap
        pq.write_table(pa.table({"page_id": [r[0]], "url": [r[1]], "html": [r[2]]}), f"{tmp}/pages.parquet/part-{k}.parquet")
    table = spark.read.parquet(f"{tmp}/pages.parquet")
    path = f"{tmp}/warc"
    warc.write_archives(table, path)
    assert spark.read.option("lineSep", "\n").text(path).selectExpr("max(octet_length(value))").first()[0] <= warc.CHUNK_BYTES + 2
    got = [tuple(r) for r in warc.archived(table).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
