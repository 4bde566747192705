"""WARC archives as chunked records.

A payload becomes chunk rows (record, chunk number, body), cut from its buffer one after the other, each with
the digest and length of the payload up to its end. They are written once, as the chunk table, and nothing
after that holds a whole payload: what follows moves chunks. Records with equal payloads of
``revisit_bytes`` or more are one response, that with the largest id, and revisits that refer to it;
which is decided over the last chunks' digests alone and meets the chunks as a row a revisit, sorted in
front of them.

On disk a chunk is a WARC record: the first of a payload is the ``response`` (with
``WARC-Segment-Number`` 1 if there are more), the others are ``continuation`` records, the last of
which has ``WARC-Segment-Total-Length``, as the standard segments records. Files are written and
read by Spark's text source, so archives can be in any store that Spark reaches; they are gzipped
whole, which also keeps a file in one task. The reader is a state machine over a file's lines that
goes by Content-Length, so a payload may hold anything, also what looks like a record. It gives chunk
rows with running digests again, which are held against those in the headers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tsquality.llm.common import written
from tsquality.session import scratch_path

CHUNK_BYTES = 65_536
#: Chunks are sent on when they hold so many bytes together.
TOGETHER = 4 << 20

_CHUNK = pa.schema([("row", pa.int64()), ("record_id", pa.int64()), ("url", pa.string()), ("chunk", pa.int32()),
                    ("bytes", pa.int64()), ("sha1", pa.string()), ("last", pa.bool_()), ("total_sha1", pa.string()),
                    ("body", pa.string())])
_CHUNK_DDL = ("row BIGINT, record_id BIGINT, url STRING, chunk INT, bytes BIGINT, sha1 STRING, last BOOLEAN, "
              "total_sha1 STRING, body STRING")


def cuts(raw: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Where chunks of about ``size`` bytes of a UTF-8 buffer begin and end, at borders of characters; one empty
    chunk if it is empty."""
    at = 0
    while at < len(raw) or not at:
        to = min(len(raw), at + max(4, size))
        while to < len(raw) and raw[to] & 0xC0 == 0x80:  # inside a character
            to -= 1
        yield at, to
        if to == len(raw):
            return
        at = to


def _chunked(size: int):
    """mapInArrow function: (row, record_id, url, payload) to chunk rows, a few megabytes at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = zip(*(b.column(c).to_pylist() for c in ("row", "record_id", "url")))
            out, held = [], 0
            for k, (row, record_id, url) in enumerate(keys):
                raw = np.frombuffer(b.column("payload")[k].as_buffer(), np.uint8)  # a view, no copy
                total, parts = hashlib.sha1(), list(cuts(raw, size))
                for a, z in parts:
                    total.update(raw[a:z])
                whole, running = total.hexdigest(), hashlib.sha1()
                for chunk, (a, z) in enumerate(parts):
                    last = z == len(raw)
                    running.update(raw[a:z])
                    out.append((row, record_id, url, chunk, z, whole if last else running.hexdigest(), last, whole,
                                raw[a:z].tobytes()))
                    held += z - a
                    if held >= TOGETHER:
                        yield _chunk_batch(out)
                        out, held = [], 0
            if out:
                yield _chunk_batch(out)
    return run


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    *columns, bodies = zip(*rows)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _CHUNK)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(bodies, pa.binary()).cast(pa.string())], schema=_CHUNK)


def chunk_table(rows: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """row, record_id, url, chunk, of the payload up to the chunk's end bytes and sha1, last, the whole payload's sha1
    and the chunk's body. ``rows``: row, record_id, url, payload (not null)."""
    return rows.select("row", "record_id", "url", "payload").mapInArrow(_chunked(size), _CHUNK_DDL)


def revisits(ends: DataFrame, revisit_bytes: int) -> DataFrame:
    """row, refers_to of the records that repeat a payload. ``ends``: row, record_id, bytes, sha1 of last chunks.

    Equal payloads meet as one row a task before the shuffle; the join that follows is one that
    Spark splits where a payload has very many copies.
    """
    large = ends.where(F.col("bytes") >= revisit_bytes)
    first = large.groupBy("sha1", "bytes").agg(F.max("record_id").alias("most"), F.count("*").alias("n")) \
        .where("n > 1 AND most IS NOT NULL").drop("n")
    return large.join(first, ["sha1", "bytes"]).where(~F.col("record_id").eqNullSafe(F.col("most"))) \
        .select("row", F.col("most").alias("refers_to"))


def _urn(record_id: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(record_id.cast("string"), F.lit("none")), F.lit(">"))


def records(chunks: DataFrame, again: DataFrame) -> DataFrame:
    """``value``: the text of each WARC record less its last CRLF, a record's segments one after the other."""
    crlf = "\r\n"
    # A revisit's row comes first, before the chunks of its record, and is carried along them.
    noted = chunks.withColumn("refers_to", F.lit(None).cast("bigint")).unionByName(
        again.withColumn("chunk", F.lit(-1)), allowMissingColumns=True)
    along = W.Window.partitionBy("row").orderBy("chunk").rowsBetween(W.Window.unboundedPreceding, 0)
    d = noted.withColumn("refers_to", F.max("refers_to").over(along))
    d = d.where((F.col("chunk") >= 0) & (F.col("refers_to").isNull() | F.col("last")))
    revisit = F.col("refers_to").isNotNull()
    d = d.withColumns({"segment": F.when(revisit, 1).otherwise(F.col("chunk") + 1), "body": F.when(revisit, "").otherwise(F.col("body"))})
    more = ~revisit & ~(F.col("last") & (F.col("segment") == 1))
    kind = F.when(revisit, "revisit").when(F.col("segment") > 1, "continuation").otherwise("response")
    own = F.concat(F.lit("<urn:row:"), F.col("row").cast("string"), F.lit(">"))

    def header(name: str, value: Column, when: Column | None = None) -> Column:
        line = F.concat(F.lit(f"{name}: "), value, F.lit(crlf))
        return line if when is None else F.when(when, line).otherwise("")
    # A line break in a URL would end the header; such bytes are percent-encoded, as URLs require.
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    head = F.concat(
        F.lit(f"WARC/1.1{crlf}"), header("WARC-Type", kind),
        header("WARC-Record-ID", F.when(F.col("segment") > 1, F.concat(
            F.lit("<urn:row:"), F.concat_ws(":", F.col("row").cast("string"), F.col("segment").cast("string")), F.lit(">")))
            .otherwise(own)),
        header("WARC-Concurrent-To", _urn(F.col("record_id"))),
        header("WARC-Target-URI", url),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("total_sha1"))),
        header("WARC-Refers-To", _urn(F.col("refers_to")), revisit),
        header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), revisit),
        header("WARC-Refers-To-Payload-Length", F.col("bytes").cast("string"), revisit),
        header("WARC-Segment-Number", F.col("segment").cast("string"), more),
        header("WARC-Segment-Origin-ID", own, F.col("segment") > 1),
        header("WARC-Segment-Total-Length", F.col("bytes").cast("string"), more & F.col("last")),
        header("Content-Length", F.octet_length("body").cast("string")), F.lit(crlf))
    return d.select(F.concat(head, F.col("body"), F.lit(crlf)).alias("value"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   revisit_bytes: int = 1000, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Gzipped WARC files of ``pages`` under ``path``.

    A null payload is empty. Rows with a repeated id are records each; those that have the largest
    id of their payload are all responses. A null id is never the largest; its record is a revisit
    where the payload has a row with an id. A payload of any length is cut from the one buffer in which
    Spark hands it over. Other columns are not read.
    """
    rows = pages.select(F.col(id_col).cast("bigint").alias("record_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload")) \
        .withColumn("row", F.monotonically_increasing_id())
    chunks = written(chunk_table(rows, chunk_bytes), "chunks", compression="zstd")  # row numbers stay what they are
    again = revisits(chunks.where("last").select("row", "record_id", "bytes", "sha1"), revisit_bytes)
    records(chunks, again).write.option("compression", "gzip").option("lineSep", "\r\n").text(path)


_READ = pa.schema([("record_row", pa.int64()), ("record_id", pa.int64()), ("kind", pa.string()), ("segment", pa.int32()),
                   ("bytes", pa.int64()), ("sha1", pa.string()), ("last", pa.bool_()), ("refers_to", pa.int64()),
                   ("url", pa.string()), ("stated", pa.string()), ("body", pa.string())])
_READ_DDL = ("record_row BIGINT, record_id BIGINT, kind STRING, segment INT, bytes BIGINT, sha1 STRING, last BOOLEAN, "
             "refers_to BIGINT, url STRING, stated STRING, body STRING")


def _number(urn: str) -> int | None:
    tail = urn.rpartition(":")[2].rstrip(">")
    return None if tail == "none" else int(tail)


def _parsed(with_body: bool):
    """mapInArrow function over (file, line) in file order: a row a WARC record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        file, head, left, body, digest, size = None, None, 0, [], None, 0

        def start():
            nonlocal head, left, body
            head, left, body = None, 0, []

        def finish():
            kind = head["WARC-Type"]
            segment = int(head.get("WARC-Segment-Number", 1))
            last = segment == 1 and "WARC-Segment-Number" not in head or "WARC-Segment-Total-Length" in head
            revisit = kind == "revisit"
            stated = head["WARC-Payload-Digest"].partition(":")[2]
            own = head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"])
            out.append((int(own[len("<urn:row:"):-1]), _number(head["WARC-Concurrent-To"]), kind, segment,
                        int(head["WARC-Refers-To-Payload-Length"]) if revisit else len_of(), stated if revisit else
                        digest.hexdigest(), last, _number(head["WARC-Refers-To"]) if revisit else None,
                        head["WARC-Target-URI"], stated, "".join(body) if with_body else None))

        def len_of():
            return size

        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if name != file:
                    file = name
                    start()
                line = text + "\n"
                if left:  # inside a block
                    raw = line.encode("utf-8", "surrogatepass")
                    part = raw[:left]
                    digest.update(part)
                    size += len(part)
                    if with_body:
                        body.append(part.decode("utf-8", "surrogatepass"))
                    left -= len(part)
                    if not left:
                        finish()
                        start()
                elif head is None:
                    if line == "WARC/1.1\r\n":
                        head = {}
                elif line == "\r\n":  # end of the headers
                    left = int(head["Content-Length"])
                    if int(head.get("WARC-Segment-Number", 1)) == 1:
                        digest, size = hashlib.sha1(), 0
                    if not left:
                        finish()
                        start()
                else:
                    key, _, value = line.partition(": ")
                    head[key] = value[:-2]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _READ)], schema=_READ)
                out = []
    return run


def read_archives(spark: SparkSession, path: str, with_body: bool = False) -> DataFrame:
    """A row a WARC record: for segments of a payload, bytes and sha1 are those up to the segment's end."""
    lines = spark.read.option("lineSep", "\n").text(path).select("_metadata.file_path", "value")
    return lines.mapInArrow(_parsed(with_body), _READ_DDL)


def archived(pages: DataFrame, **columns) -> DataFrame:
    """Write the archives of ``pages`` to the shared folder and read them back: a row a payload."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, **columns)
    kind = F.when(F.col("kind") == "revisit", "revisit").otherwise("response")
    wrong = F.col("sha1") != F.col("stated")
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("digest differs in record "), F.col("record_row").cast("string")))
                     .cast("string")).otherwise(F.col("sha1"))
    return read_archives(spark, path).where("last").select(
        F.col("record_id").alias("page_id"), F.col("bytes").alias("payload_bytes"), checked.alias("payload_digest"),
        kind.alias("record_type"), "refers_to")
