"""Lexical retrieval packing: windows filled with a seed document and its BM25 neighbours.

A document's ids are cut into full windows and a tail shorter than a window. Full windows are
sequences of their own. Tails are packed: they are ordered by two min-hashes of their distinct
ids, so that tails with much in common stand together, and ranges of that order, which even a hot
min-hash or repeated rows cannot fill beyond their share (a row number ends the key), become the
shards of a BM25 index. In a shard, the first unused tail is a seed; its terms query the shard's
inverted index, and the unused neighbours fill the seed's window, best first. What no neighbour fits
is filled by cutting the best one that is left, whose rest stays in the index; only where no tail
that shares a term is left do the next ones of the shard's order follow. So only a shard's last
sequence can have padding. Document frequencies and the mean length are those
of all tails of the corpus; token ids are the terms, so these statistics are bounded by the
vocabulary.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsquality.llm.common import batch, binary, encoder, gathered, id_counts, id_dtype, parts_for, vocab_size, written

_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence", pa.int64()), ("offset", pa.int64()),
                    ("ids", pa.binary())])
_PIECE_DDL = ("doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, sequence BIGINT, "
              "offset BIGINT, ids BINARY")
_CUT = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                  ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("near", pa.int64()), ("near2", pa.int64()),
                  ("ids", pa.binary())])
_CUT_DDL = ("kind INT, doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, near BIGINT, "
            "near2 BIGINT, ids BINARY")
FULL, TAIL, STATS = 0, 1, 2
#: What a worker may keep of ids of chunks: it also holds a shard, and in a pipeline what earlier stages left.
CACHE_MB = 80


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _terms(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids of each text, one text after the other, how often each occurs, and where each text begins."""
    text = np.repeat(np.arange(len(texts), dtype=np.uint64), [len(x) for x in texts])
    key = np.sort(text << np.uint64(32) | np.concatenate(texts))
    first = np.flatnonzero(np.diff(key, prepend=key[0] + np.uint64(1)))
    key, count = key[first], np.diff(first, append=len(key))
    return ((key & np.uint64(0xFFFFFFFF)).astype(np.int64), count,
            np.searchsorted(key, np.arange(len(texts), dtype=np.uint64) << np.uint64(32)))


def _cut(tokenizer: str, end_id: int, window: int, size: int, with_ids: bool):
    """mapInArrow function: (doc_id, text) to full windows, tails and the task's term statistics."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, CACHE_MB)
        end = np.array([end_id], enc.dtype).tobytes()
        order = np.random.default_rng(7).permutation(np.arange(2 * size, dtype=np.int64)).reshape(2, size)
        df = np.zeros(size, np.int64)
        for b in batches:
            full, tails, ids = [], [], []
            for doc, raw in zip(b.column(0).to_pylist(), enc.encode_all(b.column(1).to_pylist())):
                x = np.frombuffer(raw + end, enc.dtype)
                n = len(x)
                cut = n - n % window
                for at in range(0, cut, window):
                    w = x[at:at + window]
                    full.append((FULL, doc, at, window, _crc(w), n, None, None, w.tobytes() if with_ids else None))
                if n > cut:
                    tails.append((TAIL, doc, cut, n - cut, None, n))
                    ids.append(x[cut:])
            if full:
                yield batch(_CUT, **{f.name: [r[k] for r in full] for k, f in enumerate(_CUT)})
            if tails:
                terms, _, starts = _terms(ids)
                df += np.bincount(terms, minlength=size)
                near, near2 = (np.minimum.reduceat(o[terms], starts).tolist() for o in order)
                columns = [*zip(*tails), near, near2, [x.tobytes() for x in ids]]
                yield batch(_CUT, **{f.name: c for f, c in zip(_CUT, columns)})
        yield batch(_CUT, **{f.name: [None] for f in _CUT} | {"kind": [STATS], "ids": [binary(df)]})
    return run


class Shard:
    """The inverted index of a shard: postings of BM25 weights by term, of the tails that are still unused.

    Weights are whole numbers of 2^-20, so that sums are exact in whatever order they are added, and equal
    tails have equal scores. Terms that at least a quarter of the tails have are rows of a matrix, the others
    lists of postings. Both drop used tails as a quarter of them is used up.
    """

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean_length: float, k1: float, b: float):
        n = np.array([len(x) for x in tails])
        self.terms_of, tf, starts = _terms(tails)
        self.ends = np.append(starts, len(tf))
        doc = np.repeat(np.arange(len(tails)), np.diff(self.ends))
        weight = idf[self.terms_of] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * n[doc] / mean_length))
        self.weight_of = np.maximum(1, np.rint(weight * (1 << 20)))  # none is lost, however common
        counts = np.bincount(self.terms_of, minlength=len(idf))
        common = counts >= max(2, len(tails) / 4)
        self.row_of = np.where(common, np.cumsum(common) - 1, -1)
        dense = common[self.terms_of]
        self.matrix = np.zeros((int(common.sum()), len(tails)))
        self.matrix[self.row_of[self.terms_of[dense]], doc[dense]] = self.weight_of[dense]
        rest = np.flatnonzero(~dense)
        order = rest[np.argsort(self.terms_of[rest], kind="stable")]
        self.docs, self.weights = doc[order], self.weight_of[order]
        self.first = np.append(0, np.cumsum(np.where(common, 0, counts)))
        self.live = np.arange(len(tails))  # the tails that the postings and the matrix's columns are of
        self.many = counts > 1

    def _drop_used(self, unused: np.ndarray) -> None:
        keep = unused[self.live]
        if 4 * np.count_nonzero(keep) > 3 * len(keep):
            return
        held = keep[self.docs]
        self.first = np.append(0, np.cumsum(held))[self.first]
        self.docs, self.weights = (np.cumsum(keep) - 1)[self.docs[held]], self.weights[held]
        self.matrix, self.live = np.ascontiguousarray(self.matrix[:, keep]), self.live[keep]

    def scores(self, seed: int, unused: np.ndarray, query_terms: int | None) -> np.ndarray:
        """The score of each live tail for ``seed``'s query; 0 where it is used or shares no term of the query."""
        self._drop_used(unused)
        own = slice(self.ends[seed], self.ends[seed + 1])
        terms, weights = self.terms_of[own], self.weight_of[own]
        some = np.flatnonzero(self.many[terms])
        if query_terms is not None:
            some = some[np.argsort(-weights[some], kind="stable")[:query_terms]]
        terms = terms[some]
        at, to = self.first[terms], self.first[terms + 1]
        lengths = to - at
        where = np.repeat(at - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        score = np.bincount(self.docs[where], self.weights[where], minlength=len(self.live)).astype(np.float64)
        rows, asked = self.row_of[terms], np.zeros(len(self.matrix))
        asked[rows[rows >= 0]] = 1
        score += asked @ self.matrix
        return score * unused[self.live]

    def ranked(self, seed: int, unused: np.ndarray, query_terms: int | None, first: int,
               wanted: Callable[[np.ndarray], np.ndarray] | None = None) -> Iterator[np.ndarray]:
        """All unused tails that share a query term with ``seed``, best first, ties in shard order: about
        ``first`` of them, then twice as many each time, as only what is asked for is sorted. Tails that
        ``wanted`` no longer tells are left out from then on."""
        score = self.scores(seed, unused, query_terms)
        tails, found = self.live, np.flatnonzero(score)
        while len(found):
            s = score[found]
            top = s >= np.partition(s, len(s) - first)[len(s) - first] if len(s) > first else s > 0
            some, found, first = found[top], found[~top], 2 * first
            yield tails[some[np.argsort(-score[some], kind="stable")]]
            if wanted is not None:
                found = found[wanted(tails[found])]

    def neighbours(self, seed: int, unused: np.ndarray, query_terms: int | None, most: int) -> list[int]:
        """The ``most`` best unused tails that share a query term with ``seed``, best first, ties in shard order."""
        return next(self.ranked(seed, unused, query_terms, most), np.zeros(0, np.int64))[:most].tolist()


def fill(shard: Shard, lengths: list[int], window: int, query_terms: int | None = None,
         first: int = 64) -> list[tuple[int, int, int, int, int]]:
    """Pieces (sequence, offset, tail, start in the tail, length); every id of a tail is in one piece.

    Of all neighbours, those that fit whole are taken, best first; what then is free is filled by
    cutting the best that is left. ``first`` is how many are sorted at first, and bounds none.
    """
    begin, left = [0] * len(lengths), np.array(lengths, np.int64)
    unused = np.ones(len(lengths), bool)
    out, sequence, next_seed = [], -1, 0

    def take(k: int, n: int) -> None:
        nonlocal offset
        out.append((sequence, offset, k, begin[k], n))
        begin[k], offset = begin[k] + n, offset + n
        left[k] -= n
        unused[k] = left[k] > 0

    def wanted(tails: np.ndarray) -> np.ndarray:
        """Those that may still be taken: as the best of the rest is known, those that fit whole."""
        return left[tails] <= window - offset if rest is not None else left[tails] > 0

    while next_seed < len(lengths):
        if not left[next_seed]:
            next_seed += 1
            continue
        seed, sequence, offset, rest = next_seed, sequence + 1, 0, None
        take(seed, int(left[seed]))
        for near in shard.ranked(seed, unused, query_terms, first, wanted) if offset < window else ():
            for k in near[left[near] <= window - offset].tolist():
                if left[k] <= window - offset:
                    take(k, int(left[k]))
            if rest is None:
                rest = next(iter(near[left[near] > 0].tolist()), None)
            if offset == window:
                break
        if offset < window and rest is not None:
            take(rest, window - offset)
        at = next_seed
        while offset < window:  # no neighbour is left: the next unused tails of the order
            while at < len(lengths) and not left[at]:
                at += 1
            if at == len(lengths):
                break
            take(at, min(int(left[at]), window - offset))
    return out


def _packed(df: np.ndarray, n_tails: int, mean_length: float, dtype: str, window: int, query_terms: int | None, k1: float,
            b: float, with_ids: bool):
    idf = np.log1p((n_tails - df + 0.5) / (df + 0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = gathered(batches)
        if got is None:
            return
        doc, start, total = (got.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens"))
        part = got.column("part")[0].as_py()
        tails = [np.frombuffer(x.as_py(), dtype) for x in got.column("ids")]
        del got
        pieces = fill(Shard(tails, idf, mean_length, k1, b), [len(x) for x in tails], window, query_terms)
        for at in range(0, len(pieces), 10_000):
            rows = []
            for sequence, offset, k, begin, n in pieces[at:at + 10_000]:
                x = tails[k][begin:begin + n]
                rows.append((doc[k], start[k] + begin, n, _crc(x), total[k], (part << 32) + sequence, offset,
                             x.tobytes() if with_ids else None))
            yield batch(_PIECE, **{f.name: [r[k] for r in rows] for k, f in enumerate(_PIECE)})
    return run


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048, id_col: str = "doc_id",
                   text_col: str = "text", shard_tokens: int = 2_000_000, query_terms: int | None = None, k1: float = 1.2,
                   b: float = 0.75, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, of the tokenizer's
    own width) of every piece.

    A null or empty text is the end id alone. Rows with equal or null ids are packed each on its
    own, ties in score go by the shard's order, an empty table gives no piece, and columns other
    than the two named are not read. A seed's query has all of its terms, or, with ``query_terms``, so
    many of the highest weight; a tail that shares none of these is no neighbour then.
    """
    size = vocab_size(tokenizer)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = rows.mapInArrow(_cut(tokenizer, end_id, window, size, with_ids), _CUT_DDL)
    cut = written(cut.withColumn("row", F.monotonically_increasing_id()), "cut", compression="zstd")
    full, tails = cut.where(F.col("kind") == FULL), cut.where(F.col("kind") == TAIL)
    n_tails, n_ids = tails.agg(F.count("*"), F.sum("length")).first()
    counts = id_counts(cut.where(F.col("kind") == STATS).select("ids"), size).toArrow()  # bounded by the vocabulary
    df = np.zeros(size, np.int64)
    df[counts.column("id").to_numpy()] = counts.column("n").to_numpy()
    shards = (tails.select("doc_id", "start", "doc_tokens", "ids", "near", "near2", "row")
              .repartitionByRange(parts_for(n_ids, shard_tokens), F.xxhash64("near"), "near2", "row")
              .sortWithinPartitions(F.xxhash64("near"), "near2", "row")
              .select("doc_id", "start", "doc_tokens", "ids", F.spark_partition_id().alias("part")))
    run = _packed(df, n_tails, (n_ids or 0) / max(1, n_tails), id_dtype(size), window, query_terms, k1, b, with_ids)
    ids = ["ids"] if with_ids else []
    packed = shards.mapInArrow(run, _PIECE_DDL).withColumn("sequence_id", F.col("sequence") * 2)
    alone = full.withColumns({"sequence_id": F.col("row") * 2 + 1, "offset": F.lit(0).cast("bigint")})
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *ids]
    return packed.select(*cols).unionAll(alone.select(*cols))
