"""Importance resampling towards a target distribution, by hashed features.

Features are the runs of 1 to ``max_run`` consecutive words, hashed to buckets by their CRC-32. The
corpus and a target corpus are counted by bucket; a bucket's gain is the log of how much likelier the
target has it, a document's weight the sum of its features' gains, and adding Gumbel noise to the
weights and taking the highest draws documents without replacement in proportion to them.

CRC-32 is linear over XOR but for a constant of the length. So the checksum of a span is the XOR of
what each of its bytes contributes at its distance from the span's end, a table of 64 distances by
256 bytes, and of the length's constant. ``bitwise_xor.reduceat`` folds the contributions of all spans
of many texts at once. Spans of more than 64 bytes are cut into blocks aligned with their ends, and the
blocks' checksums fold pairwise, the left one shifted by the right one's length.

On Spark: one pass hashes each text once and writes the buckets of its features as packed numbers;
bucket counts are summed in the tasks and then by bucket; a second pass over the written buckets adds
up gains; ranks come from range partitions, whose sizes are summed up over a row a partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsquality.llm.common import parts_for, written
from tsquality.llm.spans import Words, positions, text_words

#: Distances from the end that the table holds, and so the bytes of a block of a long span.
BLOCK = 64
#: The polynomial of CRC-32, reflected (fixed value).
POLYNOMIAL = 0xEDB88320

_HASHED = "doc_id STRING, id BIGINT, n_words BIGINT, n_features BIGINT, buckets BINARY"


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Contributions by [distance from the end, byte], and the shifts of a state by 2^k zero bytes,
    each as contributions by [byte of the state, its value]."""
    own = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        own = np.where(own & 1, own >> 1 ^ np.uint32(POLYNOMIAL), own >> 1).astype(np.uint32)
    by_distance = np.empty((BLOCK, 256), np.uint32)
    by_distance[0] = own
    for d in range(1, BLOCK):
        before = by_distance[d - 1]
        by_distance[d] = own[before & 0xFF] ^ before >> 8
    value = np.arange(256, dtype=np.uint32)
    one = np.stack([own, value, value << 8, value << 16]).astype(np.uint32)  # a state's low byte is used, the rest moves down
    shifts = [one]
    for _ in range(40):
        shifts.append(shifted(shifts[-1], shifts[-1]))
    return by_distance, shifts


def shifted(states: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """States after the zero bytes that ``shift`` stands for."""
    return shift[0][states & 0xFF] ^ shift[1][states >> 8 & 0xFF] ^ shift[2][states >> 16 & 0xFF] ^ shift[3][states >> 24]


BY_DISTANCE, SHIFTS = _tables()


@lru_cache(maxsize=65_536)
def _constant(length: int) -> int:
    """The checksum of ``length`` zero bytes: what a span's length alone contributes."""
    state = np.array([0xFFFFFFFF], np.uint32)
    for k, bit in enumerate(reversed(f"{length:b}")):
        if bit == "1":
            state = shifted(state, SHIFTS[k])
    return int(state[0]) ^ 0xFFFFFFFF


_CONSTANTS = np.array([_constant(n) for n in range(BLOCK + 1)], np.uint32)


def _folded(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The contributions of spans of 1 to 64 bytes, without the length's."""
    at, first = positions(starts, lengths)
    from_end = np.repeat(first + lengths - 1, lengths) - np.arange(len(at))
    return np.bitwise_xor.reduceat(BY_DISTANCE.ravel()[from_end << 8 | data[at]], first)


def span_crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each ``data[start:end]``; the spans may overlap, none is empty."""
    lengths = ends - starts
    if not len(lengths):
        return np.zeros(0, np.uint32)
    out = np.empty(len(lengths), np.uint32)
    short, long = np.flatnonzero(lengths <= BLOCK), np.flatnonzero(lengths > BLOCK)
    for at in range(0, len(short), 1 << 18):  # so many at once bound the arrays
        few = short[at:at + (1 << 18)]
        out[few] = _folded(data, starts[few], lengths[few]) ^ _CONSTANTS[lengths[few]]
    n_blocks = -(-lengths[long] // BLOCK)
    for n in np.unique(n_blocks):  # spans of as many blocks fold together
        own = long[n_blocks == n]
        for few in np.array_split(own, parts_for(len(own) * int(n) * BLOCK, 1 << 22)):
            ends_of = ends[few, None] - BLOCK * np.arange(n - 1, -1, -1)
            starts_of = np.maximum(ends_of - BLOCK, starts[few, None])
            v = _folded(data, starts_of.ravel(), (ends_of - starts_of).ravel()).reshape(len(few), n)
            level = BLOCK.bit_length() - 1
            while v.shape[1] > 1:
                if v.shape[1] % 2:  # zeros in front contribute nothing
                    v = np.hstack([np.zeros((len(v), 1), np.uint32), v])
                v = shifted(v[:, 0::2], SHIFTS[level]) ^ v[:, 1::2]
                level += 1
            out[few] = v[:, 0] ^ np.array([_constant(int(x)) for x in lengths[few]], np.uint32)
    return out


def _joined(words: Words) -> Words:
    """The same words with one byte, a space, between those of a text."""
    lengths = words.ends - words.starts
    at, first = positions(words.starts, lengths)
    starts = first + np.arange(len(lengths))
    data = np.full(len(at) + len(lengths), ord(" "), np.uint8)
    data[positions(starts, lengths)[0]] = words.data[at]
    return Words(data, starts, starts + lengths, words.first, words.begin)


def features(words: Words, max_run: int) -> tuple[np.ndarray, np.ndarray]:
    """(CRC-32 of every feature, its text) of the runs of 1 to ``max_run`` words, by run length."""
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    if max_run > 1:
        words = _joined(words)
    crcs, of = [span_crc32(words.data, words.starts, words.ends)], [text]
    for n in range(2, max_run + 1):
        whole = np.flatnonzero(text[:len(text) - n + 1] == text[n - 1:]) if len(text) >= n else np.zeros(0, int)
        crcs.append(span_crc32(words.data, words.starts[whole], words.ends[whole + n - 1]))
        of.append(text[whole])
    return np.concatenate(crcs), np.concatenate(of)


def _hashed(max_run: int, buckets: int):
    """mapInArrow function: (doc_id, id, text) to the buckets of all features of each text."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_features, packed = [], [], []
            for _, words in text_words(b.column("text")):
                crcs, of = features(words, max_run)
                n_texts = len(words.first) - 1
                counts = np.bincount(of, minlength=n_texts)
                if max_run > 1:
                    crcs = crcs[np.argsort(of, kind="stable")]
                ids, cuts = (crcs % np.uint32(buckets)).astype(kind).tobytes(), np.cumsum(counts) * kind().itemsize
                packed += [ids[a:z] for a, z in zip([0, *cuts[:-1].tolist()], cuts.tolist())]
                n_words.append(np.diff(words.first))
                n_features.append(counts)
            if packed:
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("id"), pa.array(np.concatenate(n_words), pa.int64()),
                     pa.array(np.concatenate(n_features), pa.int64()), pa.array(packed, pa.binary())],
                    names=["doc_id", "id", "n_words", "n_features", "buckets"])
    return run


def _unpacked(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(the packed buckets of all rows in turn, where each row ends among them)."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind), np.cumsum([len(x) // kind().itemsize for x in values])


def _counted(buckets: int):
    """mapInArrow function: packed buckets to one row for each bucket that the task has seen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(_unpacked(b.column("buckets"), buckets)[0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])
    return run


def bucket_counts(hashed: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall into each bucket; the driver gets a row a bucket."""
    rows = hashed.select("buckets").mapInArrow(_counted(buckets), "bucket BIGINT, n BIGINT") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log of how much likelier the target has each bucket (add-one smoothing), floored."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weighed(gain: np.ndarray):
    """mapInArrow function: packed buckets to the sum of their gains."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ends = _unpacked(b.column("buckets"), len(gain))
            upto = np.append(0, np.cumsum(gain[ids]))[np.append(0, ends)]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in ("doc_id", "id", "n_words", "n_features")),
                                              pa.array(np.diff(upto), pa.int64())],
                                             names=["doc_id", "id", "n_words", "n_features", "weight"])
    return run


def ranked(rows: DataFrame, order: list[Column], total: int, part_rows: int = 2_000_000) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, ...) along ``order``, which must end in a unique column so that no
    value, however common, fills a partition alone."""
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # the position in the partition
    spread = rows.repartitionByRange(parts_for(total, part_rows), *order).sortWithinPartitions(*order)
    spread = written(spread.withColumn("part", F.spark_partition_id()).withColumn("place", place), "ranked")
    before, sums = 0, []
    for r in spread.groupBy("part").count().orderBy("part").collect():  # a row a partition
        sums.append((r["part"], before))
        before += r["count"]
    sums = rows.sparkSession.createDataFrame(sums, "part INT, before BIGINT")
    return spread.join(F.broadcast(sums), "part").withColumn("rank", F.col("before") + F.col("place") + 1) \
        .drop("part", "place", "before")


def resampled(docs: DataFrame, target: DataFrame, max_run: int = 1, buckets: int = 10_000, percent: int = 10,
              min_words: int = 20, seed: str = "2024", id_col: str = "doc_id", text_col: str = "text",
              target_text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null where it is not drawn.

    Drawn are ``percent`` (rounded down) of the documents of ``min_words`` words or more, those of the
    highest scores; equal scores go by the smaller id, null ids last, then by row. A null text has no
    words and so the weight 0, as has one without words; a null id's noise is that of the empty id.
    Repeated rows are documents of their own; those of one id have the same noise. Without documents
    there are no rows, without target texts all gains are those of no target features. Texts of any
    length are hashed whole. Other columns are not read.
    """
    def hashed(df: DataFrame, id_column: Column, column: str) -> DataFrame:
        given = df.select(id_column.cast("string").alias("doc_id"), F.monotonically_increasing_id().alias("id"),
                          F.col(column).cast("string").alias("text"))
        return given.mapInArrow(_hashed(max_run, buckets), _HASHED)
    source = written(hashed(docs, F.col(id_col), text_col), "features", compression="uncompressed")
    gain = gains(bucket_counts(source, buckets), bucket_counts(hashed(target, F.lit(None), target_text_col), buckets))
    weighed = source.mapInArrow(_weighed(gain), "doc_id STRING, id BIGINT, n_words BIGINT, n_features BIGINT, weight BIGINT")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("doc_id", F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))
    scored = weighed.select(F.col("doc_id").cast(docs.schema[id_col].dataType).alias("doc_id"), "id", "n_words", "n_features",
                            "weight", (F.col("weight") + noise).alias("score"))
    scored = written(scored, "scored")
    enough = F.col("n_words") >= min_words
    total = scored.where(enough).count()
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("id").asc()]
    places = ranked(scored.where(enough), order, total)
    drawn = F.when(F.col("rank") <= total * percent // 100, F.col("rank"))
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("bigint"))
    return places.withColumn("rank", drawn).unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
