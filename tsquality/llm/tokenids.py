"""Token ids as files: frequency-ranked ids in a byte-aligned variable-length code.

An archive is a folder of two Parquet tables.

``ranks``   rank, id: the most frequent id of the whole corpus has rank 0 (ties: the smaller id).
``blocks``  part, block, first, doc_ids, doc_tokens, control, data: documents in ascending id
            order over parts and blocks. Ranks are written with 1 to 4 little-endian bytes;
            two bits a rank, four ranks a byte, stand apart in ``control`` and give the bytes
            less one; ``data`` has the bytes alone. ``first`` is the number of ids before the
            block in its part.

The writer tokenizes once into a scratch table (with the id counts of each task beside it), ranks
the ids by the summed counts, deals documents to parts by ranges of (doc_id, row number), so that
no id, not even a null or repeated one, fills a part alone, and codes each part as a stream.
The reader maps blocks to documents; only rows of a few numbers are shuffled after that.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tsquality.llm.common import batch, binary, encoder, id_counts, id_dtype, parts_for, vocab_size, written
from tsquality.session import scratch_path

#: For each control byte: the bytes of its four values, and by width (bytes a value has room for) which
#: bytes of four values are written.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
MASKS = {width: (np.arange(width) < LENGTHS[:, :, None]).reshape(256, 4 * width) for width in (2, 4)}

_TOKENS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])
_TOKENS_DDL = "doc_id BIGINT, n BIGINT, ids BINARY, counts BINARY"
_BLOCK = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
                    ("control", pa.binary()), ("data", pa.binary())])
_BLOCK_DDL = ("part INT, block INT, first BIGINT, n_ids BIGINT, doc_ids ARRAY<BIGINT>, doc_tokens ARRAY<BIGINT>, "
              "control BINARY, data BINARY")
_DOC = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()),
                  ("ids_crc32", pa.int64()), ("ids", pa.binary())])
_DOC_DDL = "doc_id BIGINT, part INT, first BIGINT, n_tokens BIGINT, ids_crc32 BIGINT, ids BINARY"


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Ranks to (control, data)."""
    n = len(ranks)
    r = np.zeros(-(-n // 4) * 4, "<u4")
    r[:n] = ranks
    extra = (r > 0xFF).view(np.uint8)
    width = 2
    if n and r.max() > 0xFFFF:
        extra, width = extra + (r > 0xFFFF) + (r > 0xFFFFFF), 4
    codes = extra.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    written = MASKS[width][control].ravel()[:n * width]
    return control.tobytes(), r.astype(f"<u{width}").view(np.uint8)[:n * width][written].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """(control, data) back to ``n`` ranks: which bytes are written comes from a table of 256 rows."""
    codes = np.frombuffer(control, np.uint8)
    width = 4 if (codes & 0b10101010).any() else 2
    out = np.zeros(n * width, np.uint8)
    out[MASKS[width][codes].ravel()[:n * width]] = np.frombuffer(data, np.uint8)
    return out.view(f"<u{width}").astype(np.uint32)


def tokenized(path: str, end_id: int, size: int):
    """mapInArrow function: (doc_id, text) to compressed ids, then one row of id counts a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, squeeze = encoder(path), zstandard.ZstdCompressor(level=1)
        counts, end = np.zeros(size, np.int64), np.array([end_id], enc.dtype).tobytes()
        width = np.dtype(enc.dtype).itemsize
        for b in batches:
            ids = [x + end for x in enc.encode_all(b.column(1).to_pylist())]
            counts += np.bincount(np.frombuffer(b"".join(ids), enc.dtype), minlength=size)
            yield batch(_TOKENS, doc_id=b.column(0), n=[len(x) // width for x in ids],
                        ids=[squeeze.compress(x) for x in ids], counts=[None] * len(ids))
        yield batch(_TOKENS, doc_id=[None], n=[None], ids=[None], counts=[binary(counts)])
    return run


def frequency_ranks(tokens: DataFrame, size: int) -> DataFrame:
    """rank, id over the whole vocabulary (its size bounds this table), ids that never occur last."""
    counts = id_counts(tokens.where("counts IS NOT NULL").select("counts"), size)
    every = tokens.sparkSession.range(size).join(counts, "id", "left")
    order = W.Window.orderBy(F.coalesce("n", F.lit(0)).desc(), "id")
    return every.select((F.row_number().over(order) - 1).alias("rank"), "id")


def _coded(rank_of: np.ndarray, dtype: str, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        part = block = first = n_ids = 0
        held: list[tuple[int | None, bytes]] = []

        def out():
            nonlocal block, first, n_ids, held
            ids = np.frombuffer(b"".join(x for _, x in held), dtype)
            control, data = pack(rank_of[ids])
            row = batch(_BLOCK, part=[part], block=[block], first=[first], n_ids=[len(ids)],
                        doc_ids=[[d for d, _ in held]],
                        doc_tokens=[[len(x) // np.dtype(dtype).itemsize for _, x in held]],
                        control=[control], data=[data])
            block, first, n_ids, held = block + 1, first + len(ids), 0, []
            return row

        for b in batches:
            for p, d, n, x in zip(b.column("part"), b.column("doc_id"), b.column("n"), b.column("ids")):
                part = p.as_py()
                held.append((d.as_py(), expand.decompress(x.as_py())))
                n_ids += n.as_py()
                if n_ids >= block_ids:
                    yield out()
        if held:
            yield out()
    return run


def write_archive(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                  text_col: str = "text", part_ids: int = 16_000_000, block_ids: int = 262_144) -> None:
    """Write the archive of ``docs``. Null and empty texts are just the end id; rows with equal or
    null ids keep one entry each (null ids come first); other columns are not read."""
    spark, size = docs.sparkSession, vocab_size(tokenizer)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tokens = rows.mapInArrow(tokenized(tokenizer, end_id, size), _TOKENS_DDL) \
        .withColumn("row", F.monotonically_increasing_id())
    tokens = written(tokens, "tokens", compression="uncompressed")
    frequency_ranks(tokens, size).coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = _ranks(spark, path)[1]
    total = tokens.agg(F.sum("n")).first()[0]
    parts = (tokens.where("counts IS NULL").select("doc_id", "row", "n", "ids")
             .repartitionByRange(parts_for(total, part_ids), "doc_id", "row")
             .sortWithinPartitions("doc_id", "row").withColumn("part", F.spark_partition_id()))
    parts.mapInArrow(_coded(rank_of, id_dtype(size), block_ids), _BLOCK_DDL) \
        .write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _ranks(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    """ids by rank, ranks by id. The vocabulary's size bounds what comes to the driver."""
    rows = spark.read.parquet(f"{path}/ranks").toArrow()
    rank, ids = rows.column("rank").to_numpy(), rows.column("id").to_numpy()
    id_of, rank_of = np.zeros(len(ids), np.uint32), np.zeros(len(ids), np.uint32)
    id_of[rank], rank_of[ids] = ids, rank
    return id_of, rank_of


def _decoded(id_of: np.ndarray, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids = id_of[unpack(r["control"], r["data"], r["n_ids"])].astype("<u4")
                ends = np.cumsum(np.array(r["doc_tokens"], np.int64))
                raw, cuts = memoryview(ids.tobytes()), [0, *(4 * ends).tolist()]
                each = [raw[a:z] for a, z in zip(cuts, cuts[1:])]
                yield batch(_DOC, doc_id=r["doc_ids"], part=[r["part"]] * len(each),
                            first=[r["first"] + a // 4 for a in cuts[:-1]], n_tokens=r["doc_tokens"],
                            ids_crc32=[zlib.crc32(x) for x in each],
                            ids=[bytes(x) if with_ids else None for x in each])
    return run


def read_archive(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids, little-endian unsigned 32-bit) of each document."""
    blocks = spark.read.schema(_BLOCK_DDL).parquet(f"{path}/blocks")
    docs = blocks.mapInArrow(_decoded(_ranks(spark, path)[0], with_ids), _DOC_DDL)
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row a part
    before = W.Window.orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    out = docs.join(sums, "part").withColumn("start", F.col("first") + F.col("before"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def token_archive(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write an archive to the shared folder and read it back."""
    path = scratch_path(docs.sparkSession, "archive")
    write_archive(docs, path, tokenizer, end_id)
    return read_archive(docs.sparkSession, path)
