"""Vector code compression: product codes, assigned by Orchard's search.

A vector's components become integers, ``floor(scale * x)``, and the vector is cut into parts. Each
part position has a codebook; a vector's code is the index of the nearest entry for each part. Codebooks
start as the parts of the first vectors in the order of ids and are refined by rounds of assigning every
part to its nearest entry and replacing entries by the floored means of their parts.

The nearest entry is found by Orchard's search. For every entry the others are listed by distance. A
search starts at some entry and walks down its list; what it meets is measured once (marked) against the
query; where an entry is nearer (or as near, with a lower index), the walk goes on in that entry's list;
it ends where the list is beyond twice the current distance, since what lies there is farther from the
query than the current entry, by the triangle inequality. All comparisons are of whole squared
distances (four times the squared one, not twice the root), so ties are exact. The searches of a batch
of vectors walk side by side as arrays.

On Spark: a round is a map over the vectors, whose tasks add up their parts by entry first, and a sum of
one number for each (position, entry, component) and task. The codebooks, of a size that only the
parameters give, go to the driver and back. Vectors are written once as integers.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsquality.llm.common import binary, written

_LONG = (1 << 63) - 1
#: Components up to this size have four times their squared distances in a long, for vectors of up to 16
#: components (fewer for longer ones, see ``_integers``); beyond it Python's integers are used.
_SMALL = float(1 << 26)
#: Sums of large components are sent in digits of so many bits.
_DIGIT = 40


def _whole(scale: float):
    """mapInArrow function: (id, label, components) to (id, label, dim, packed floored doubles) of whole vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, dims, out = [], [], []
            for k, v in enumerate(b.column("v")):
                if not v.is_valid or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all():
                    with np.errstate(over="ignore"):
                        x = np.floor(scale * x)
                    kept.append(k)
                    dims.append(len(x))
                    out.append(binary(np.nan_to_num(x) + 0.0))  # no negative zeros
            keys = b.select(["id", "label"]).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([*keys.columns, pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                                             names=["id", "label", "dim", "v"])
    return run


def _integers(x: np.ndarray) -> np.ndarray:
    """Whole doubles as integers: 64-bit ones where every squared distance fits, Python's otherwise."""
    if np.abs(x).max(initial=0) * np.sqrt(max(1, x.shape[-1] / 16)) < _SMALL:
        return x.astype(np.int64)
    return np.frompyfunc(int, 1, 1)(x).astype(object)


def _rows(b: pa.RecordBatch, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(b.column("v").to_pylist()), np.float64).reshape(b.num_rows, dim)


def cuts(dim: int, parts: int) -> list[tuple[int, int]]:
    """Where each part lies; a number of components that the parts do not divide is cut as evenly as can be."""
    return [(dim * p // parts, dim * (p + 1) // parts) for p in range(parts)]


class Codebook:
    """The entries of one part position, and for each the others by distance (ties: the lower index)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = np.array([((entries - e) ** 2).sum(axis=1) for e in entries]).reshape(len(entries), len(entries))
        self.near = np.array([np.lexsort((np.arange(len(entries)), row)) for row in apart], np.int32)
        self.apart = np.take_along_axis(apart, self.near, axis=1)  # from each entry, along its list
        total = entries.sum(axis=1) if entries.shape[1] else np.zeros(len(entries), np.int64)
        self.by_total = np.argsort(total, kind="stable")
        self.totals = total[self.by_total]

    def start(self, x: np.ndarray) -> np.ndarray:
        """An entry to begin at: one whose components have about the same sum."""
        at = np.searchsorted(self.totals, x.sum(axis=1) if x.shape[1] else np.zeros(len(x), np.int64))
        return self.by_total[np.minimum(at, len(self.entries) - 1)]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance to it) for each row, ties to the lower index."""
        n, size = len(x), len(self.entries)
        best = self.start(x).astype(np.int64)
        far = ((x - self.entries[best]) ** 2).sum(axis=1)
        marked = np.zeros((n, size), bool)
        marked[np.arange(n), best] = True
        place = np.zeros(n, np.int64)
        walking = np.arange(n)
        while len(walking):
            on, at = best[walking], place[walking]
            going = self.apart[on, at] <= 4 * far[walking]
            walking, on, at = walking[going], on[going], at[going]
            entry = self.near[on, at]
            place[walking] = at + 1
            new = ~marked[walking, entry]
            seen, entry = walking[new], entry[new]
            marked[seen, entry] = True
            d = ((x[seen] - self.entries[entry]) ** 2).sum(axis=1)
            better = (d < far[seen]) | (d == far[seen]) & (entry < best[seen])
            moved = seen[better]
            best[moved], far[moved], place[moved] = entry[better], d[better], 0
            walking = walking[place[walking] < size]
        return best, far


def _searched(b: pa.RecordBatch, books: dict[int, list[Codebook]]) -> Iterator[tuple[np.ndarray, int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, dim, part position, parts, nearest entries, squared distances) over a batch."""
    dims = b.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        x = _integers(_rows(b.take(pa.array(at)), dim))
        for p, (a, z) in enumerate(cuts(dim, len(books[dim]))):
            yield at, dim, p, x[:, a:z], *books[dim][p].nearest(x[:, a:z])


def _summed(shared):
    """mapInArrow function: vectors to the sums of their parts by entry, a row for each component and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        counts: dict = defaultdict(int)
        sums: dict = {}
        for b in batches:
            for _, dim, p, x, best, _ in _searched(b, books):
                order = np.argsort(best, kind="stable")
                entries, first = np.unique(best[order], return_index=True)
                totals = np.add.reduceat(x[order], first, axis=0) if x.shape[1] else np.zeros((len(entries), 0), int)
                for e, n, t in zip(entries.tolist(), np.diff(np.append(first, len(best))).tolist(), totals):
                    counts[dim, p, e] += n
                    sums[dim, p, e] = [s + int(y) for s, y in zip(sums.get((dim, p, e), [0] * len(t)), t)]
        out = []
        for key, n in counts.items():
            out.append((*key, -1, 0, n))
            for j, s in enumerate(sums[key]):
                k = 0
                while not -(1 << _DIGIT) <= s < 1 << _DIGIT:
                    s, digit = s >> _DIGIT, s & (1 << _DIGIT) - 1
                    out.append((*key, j, k, digit))
                    k += 1
                out.append((*key, j, k, s))
        columns = list(zip(*out)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["dim", "part", "entry", "j", "digit", "s"])
    return run


def _refined(vectors: DataFrame, entries: dict[int, list[np.ndarray]]) -> dict[int, list[np.ndarray]]:
    """The codebooks after one round; the driver gets a number for each component of each entry."""
    shared = vectors.sparkSession.sparkContext.broadcast(_books(entries))
    got = vectors.mapInArrow(_summed(shared), "dim BIGINT, part BIGINT, entry BIGINT, j BIGINT, digit BIGINT, s BIGINT") \
        .groupBy("dim", "part", "entry", "j", "digit").agg(F.sum("s").alias("s")).collect()
    counts, sums = {}, defaultdict(int)
    for dim, p, e, j, digit, s in got:
        if j < 0:
            counts[dim, p, e] = s
        else:
            sums[dim, p, e, j] += s << _DIGIT * digit
    out = {dim: [np.array(own, object).reshape(own.shape) for own in books] for dim, books in entries.items()}
    for (dim, p, e), n in counts.items():
        for j in range(out[dim][p].shape[1]):
            out[dim][p][e, j] = sums[dim, p, e, j] // n
    return {dim: [_integers(own.astype(np.float64)) if _doubles(own) else own for own in books] for dim, books in out.items()}


def _doubles(x: np.ndarray) -> bool:
    return all(abs(int(y)) < 1 << 53 for y in x.ravel())


def _books(entries: dict[int, list[np.ndarray]]) -> dict[int, list[Codebook]]:
    return {dim: [Codebook(own) for own in books] for dim, books in entries.items()}


def _first_entries(vectors: DataFrame, size: int, parts: int) -> dict[int, list[np.ndarray]]:
    """For each number of components that occurs, the parts of its ``size`` first vectors by id."""
    out = {}
    for dim in sorted(r["dim"] for r in vectors.select("dim").distinct().collect()):
        rows = vectors.where(F.col("dim") == dim).orderBy(F.col("id").asc_nulls_last(), "v").limit(size).select("v").collect()
        x = np.frombuffer(b"".join(r["v"] for r in rows), np.float64).reshape(len(rows), dim)
        out[dim] = [_integers(x[:, a:z]) for a, z in cuts(dim, parts)]
    return out


def _digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(y)) for own in books for y in own.ravel()).encode()).hexdigest()


def _coded(shared):
    """mapInArrow function: vectors to (id, label, dim, code, error)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for b in batches:
            codes: list = [""] * b.num_rows
            errors: list = [0] * b.num_rows
            for rows, _, _, _, best, far in _searched(b, books):
                for r, e, d in zip(rows.tolist(), best.tolist(), far.tolist()):
                    codes[r] += f"{e:02x}"
                    errors[r] += int(d)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), b.column("dim"), pa.array(codes, pa.string()),
                 pa.array([min(e, _LONG) for e in errors], pa.int64())], names=["id", "label", "dim", "code", "error"])
    return run


def coded(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: float = 1024,
          id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every whole vector.

    Vectors that are null or hold a null or a number that is not finite are dropped. Vectors with another
    number of components have codebooks of their own; an empty vector's parts are all entry 0. Codebooks
    have fewer entries where there are fewer vectors; equal ids are ordered by their vectors, null ids come
    last. Repeated rows count each. Errors beyond a long are the largest long. An empty table gives no
    rows. ``entries`` is 256 at most, so that an index has two digits. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("an index has two hexadecimal digits: 1 to 256 entries")
    spark = vectors.sparkSession
    given = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").alias("label"),
                           F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    label = vectors.schema[label_col].dataType.simpleString()
    whole = written(given.mapInArrow(_whole(scale), f"id BIGINT, label {label}, dim INT, v BINARY"), "vectors", compression="uncompressed")
    books = _first_entries(whole, entries, parts)
    for _ in range(rounds):
        books = _refined(whole, books)
    shared = spark.sparkContext.broadcast(_books(books))
    codes = written(whole.mapInArrow(_coded(shared), f"id BIGINT, label {label}, dim INT, code STRING, error BIGINT"), "codes")
    digests = spark.createDataFrame([(d, _digest(own)) for d, own in books.items()], "dim INT, codebooks_sha256 STRING")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    by_label = codes.groupBy(F.col("label").alias("own_label")).agg(
        F.least(total, F.lit(_LONG).cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    by_label = written(by_label, "labels")
    if by_label.count() <= 10_000:  # else Spark decides, and splits a label that holds many rows
        by_label = F.broadcast(by_label)
    out = codes.join(by_label, F.col("label").eqNullSafe(F.col("own_label"))).join(F.broadcast(digests), "dim")
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")
