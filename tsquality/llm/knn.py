"""Exact top-k inner products by a Voronoi join.

Pivots, rows of the data whose number grows with the square root of theirs, cut the vectors into cells
(nearest pivot). A job sums up each cell: the largest distance to the pivot and the smallest ones. Queries are
gathered into groups of bounded size, cell by cell along a chain of near pivots; a group's summary is
the same over its queries. From the summaries follows, for each group, a score that the k-th best
candidate of every query reaches: by the cells' smallest distances, and by the queries' own products with
the pivots, which are candidates themselves (of k + 1 of them one may be the query). For each candidate
there are two bounds that its score with no query of the group can pass:

    q.x <= q.pivot + |q| * distance(x, pivot)    and    q.x <= |q| * |x|,

by Cauchy-Schwarz on x = pivot + (x - pivot) and on x, and q.pivot likewise from the query cell's pivot. A
candidate goes to the groups whose score it can reach by both, and to no other. A group's candidates are
split over blocks of bounded size, each block is solved on its own against the group's queries (a
matrix product), and the blocks' best k of each query meet in one last grouping. Scores are those of
the integer components; the bounds are floats and are widened by more than their error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tsquality.llm.common import binary, parts_for, written

_LONG = (1 << 63) - 1
_FLOAT = float(1 << 53)

#: The driver plans with a row for each pair of a query cell and a data cell, at most the square of this.
MOST_PIVOTS = 1024


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers as 16-bit integers, as doubles where one does not fit: the length tells which."""
    return binary(x.astype("<i2") if np.abs(x).max(initial=0) < 1 << 15 else x)


def _unpacked(v: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(v, "<i2" if len(v) == 2 * dim else np.float64).astype(np.float64)


def quantized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, components as doubles) to (id, dim, floor(256 * component) packed), the whole vectors alone."""
    for b in batches:
        ids, out = [], []
        for i, v in zip(b.column(0).to_pylist(), b.column(1)):
            if not v.is_valid or v.values.null_count:
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(x).all():
                with np.errstate(over="ignore"):
                    x = np.floor(256 * x)
                ids.append(i)
                out.append(np.nan_to_num(x))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(x) for x in out], pa.int32()),
             pa.array([_packed(x) for x in out], pa.binary())], names=["id", "dim", "v"])


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``q`` and ``x``: by floats where these hold every sum exactly."""
    most = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1])
    if most < _FLOAT:
        return (q @ x.T).astype(np.int64)
    to_int = np.frompyfunc(int, 1, 1)
    s = to_int(q).astype(object) @ to_int(x).astype(object).T
    return np.clip(s, -_LONG, _LONG).astype(np.int64)  # a score beyond a long is the largest long


def _rows(b: pa.RecordBatch, name: str, dim: int) -> np.ndarray:
    given = b.column(name).to_pylist()
    if all(len(v) == 2 * dim for v in given):
        return np.frombuffer(b"".join(given), "<i2").reshape(len(given), dim).astype(np.float64)
    return np.array([_unpacked(v, dim) for v in given]).reshape(len(given), dim)


def _assigned(pivots: dict[int, np.ndarray], k: int):
    """(id, dim, v) to those with cell, distance to its pivot, length, and a score that k other rows reach."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            dims = b.column("dim").to_numpy()
            cell, dist, norm, reached = np.zeros(n, np.int32), np.zeros(n), np.zeros(n), np.full(n, -np.inf)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x, p = _rows(b.take(pa.array(at)), "v", dim), pivots[int(dim)]
                with np.errstate(over="ignore", invalid="ignore"):
                    dot = x @ p.T
                    far = np.array([((x - c) ** 2).sum(axis=1) for c in p]).T if len(p) * len(at) < 64 else \
                        (x ** 2).sum(axis=1)[:, None] - 2 * dot + (p ** 2).sum(axis=1)
                    own = np.nan_to_num(far, nan=np.inf).argmin(axis=1)
                    cell[at], dist[at] = own, np.sqrt(((x - p[own]) ** 2).sum(axis=1))
                    norm[at] = np.sqrt((x ** 2).sum(axis=1))
                    if len(p) > k:
                        best = np.partition(np.nan_to_num(dot, nan=-np.inf), len(p) - k - 1, axis=1)[:, len(p) - k - 1]
                        error = 1e-9 * norm[at] * np.sqrt((p ** 2).sum(axis=1)).max()
                        reached[at] = np.nan_to_num(best - error, nan=-np.inf)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(dist), pa.array(norm), pa.array(reached)],
                                             names=["id", "dim", "v", "cell", "dist", "norm", "reached"])
    return run


def _solved(k: int):
    """cogroup function: a block's candidates and its group's queries to the best k of each query."""
    def run(data: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "q_row", "id", "score"]
        none = pa.table({n: pa.array([], pa.int64()) for n in names})
        if not data.num_rows or not queries.num_rows:
            return none
        data, queries = data.combine_chunks(), queries.combine_chunks()
        dim = data.column("dim")[0].as_py()
        x, ids = _rows(data, "v", dim), data.column("id").to_numpy(zero_copy_only=False)
        # Null ids take part and come last among ties.
        nulls = data.column("id").is_null().to_numpy(zero_copy_only=False)
        order = np.lexsort((np.where(nulls, 0, ids), nulls))
        x, order_ids = x[order], data.column("id").take(pa.array(order))
        rows = data.column("row").to_numpy()[order]
        q, q_rows = _rows(queries, "q_v", dim), queries.column("q_row").to_numpy()
        out_q, out_x, out_s = [], [], []
        for at in range(0, len(q), 256):
            scores = exact_scores(q[at:at + 256], x)
            own = q_rows[at:at + 256, None] == rows[None, :]
            for i in range(len(scores)):
                s = scores[i]
                left = np.flatnonzero(~own[i])
                if not len(left):
                    continue
                s = s[left]
                floor = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else s.min()
                best = np.flatnonzero(s >= floor)
                best = best[np.argsort(-s[best], kind="stable")][:k]
                out_q += [at + i] * len(best)
                out_x.append(left[best])
                out_s.append(s[best])
        if not out_q:
            return none
        return pa.table({
            "query_id": queries.column("q_id").take(pa.array(out_q)), "q_row": pa.array(q_rows[out_q]),
            "id": order_ids.take(pa.array(np.concatenate(out_x))), "score": pa.array(np.concatenate(out_s))})
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          n_pivots: int | None = None, group_queries: int = 8192, block_rows: int = 16_384) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best among all other rows.

    Vectors that are null or hold a null or a number that is not finite take no part; a vector's
    candidates have as many components as it has. Equal scores go by the smaller id, null ids last,
    then by row. Rows with a repeated id are queries and candidates each, but a row is not its own
    candidate. Tables with one row, or none, give no rows. Other columns are not read.

    ``n_pivots`` is the square root of the number of rows by default, from 48 to MOST_PIVOTS. A task holds a
    group of queries and a block of candidates; a candidate is copied at most once for each group.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    whole = given.mapInArrow(quantized, "id BIGINT, dim INT, v BINARY").withColumn("row", F.monotonically_increasing_id())
    whole = written(whole, "vectors", compression="uncompressed")
    dims = {r["dim"]: r["count"] for r in whole.groupBy("dim").count().collect()}  # lengths that occur
    pivots = {}
    for d, n in dims.items():
        most = n_pivots or min(MOST_PIVOTS, max(48, math.isqrt(n)))
        some = whole.where(F.col("dim") == d).select("v", F.xxhash64("row").alias("h"), "row").orderBy("h", "row")
        some = [_unpacked(r["v"], d) for r in some.limit(most).collect()]
        pivots[d] = np.unique(np.array(some).reshape(len(some), d), axis=0) if d else np.zeros((1, 0))
    cells = whole.select("id", "dim", "v").mapInArrow(
        _assigned(pivots, k), "id BIGINT, dim INT, v BINARY, cell INT, dist DOUBLE, norm DOUBLE, reached DOUBLE")
    cells = written(cells.withColumn("row", F.monotonically_increasing_id()), "cells", compression="uncompressed")
    queries = cells.where(is_query)
    # Summaries. Of a cell the k + 1 smallest distances: candidates, of which one may be the query itself.
    by_dist = W.Window.partitionBy("dim", "cell").orderBy("dist")
    nearest = cells.select("dim", "cell", "dist").withColumn("r", F.row_number().over(by_dist)) \
        .where(F.col("r") <= k + 1).groupBy("dim", "cell").agg(F.collect_list("dist").alias("dists"))
    radius = cells.groupBy("dim", "cell").agg(F.max("dist").alias("radius"))
    summary = nearest.join(radius, ["dim", "cell"]).collect()  # a row a cell
    asked = queries.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("norm").alias("norm"),
                                               F.max("dist").alias("radius"), F.min("reached").alias("reached")).collect()
    groups, need = _plan(summary, asked, pivots, k, group_queries)
    if not need:
        return spark.createDataFrame([], "query_id BIGINT, rank INT, vec_id BIGINT, score BIGINT")

    def small(rows: list, schema: str) -> DataFrame:
        d = spark.createDataFrame(rows, schema)
        return F.broadcast(d) if len(rows) <= 100_000 else d
    need = small(need, "dim INT, cell INT, first INT, splits INT, least DOUBLE, least_norm DOUBLE")
    sent = cells.join(need, ["dim", "cell"]).where((F.col("dist") >= F.col("least")) & (F.col("norm") >= F.col("least_norm"))) \
        .withColumn("grp", F.explode(F.sequence("first", F.col("first") + F.col("splits") - 1)))
    sizes = sent.groupBy("grp").agg(F.count("*").alias("n")).collect()  # a row a group of queries
    blocks = small([(r["grp"], parts_for(r["n"], block_rows)) for r in sizes], "grp INT, blocks INT")
    data = sent.join(blocks, "grp").select(
        "grp", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("block"), "dim", "id", "row", "v")
    asked_rows = queries.join(small(groups, "dim INT, cell INT, first INT, splits INT"), ["dim", "cell"]).select(
        (F.col("first") + F.pmod(F.xxhash64("row"), F.col("splits"))).cast("int").alias("grp"), "id", "row", "v")
    asked_rows = asked_rows.join(blocks, "grp").select(
        F.col("grp").alias("q_grp"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("q_block"),
        F.col("id").alias("q_id"), F.col("row").alias("q_row"), F.col("v").alias("q_v"))
    found = data.groupBy("grp", "block").cogroup(asked_rows.groupBy("q_grp", "q_block")).applyInArrow(
        _solved(k), "query_id BIGINT, q_row BIGINT, id BIGINT, score BIGINT")
    best = W.Window.partitionBy("q_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")


def _plan(summary: list, asked: list, pivots: dict[int, np.ndarray], k: int, group_queries: int) -> tuple[list, list]:
    """(dim, query cell, first group, groups of the cell) and (dim, data cell, first group, groups, least distance
    and least length that are sent)."""
    groups, need, g = [], [], 0
    for dim, p in pivots.items():
        data = {r["cell"]: r for r in summary if r["dim"] == dim}
        cells = sorted(data)
        dists = np.array([d for c in cells for d in data[c]["dists"]])
        of = np.array([c for c in cells for _ in data[c]["dists"]], int)
        radius = np.array([data[c]["radius"] for c in cells])
        length = np.sqrt((p ** 2).sum(axis=1))
        held: list = []  # cells of the group that is being filled

        def close():
            nonlocal g, held
            if held:
                least = np.min([x for _, _, x, _ in held], axis=0)
                splits, norm = max(s for _, s, _, _ in held), min(x for _, _, _, x in held)
                groups.extend((dim, c, g, splits) for c, _, _, _ in held)
                need.extend((dim, c, g, splits, float(x), norm) for c, x, r in zip(cells, least, radius) if not x > r)
                g, held = g + splits, []

        n_held, by_cell = 0, {r["cell"]: r for r in asked if r["dim"] == dim}
        for r in map(by_cell.get, _chain(p, sorted(by_cell))):
            with np.errstate(all="ignore"):
                dot = p[r["cell"]] @ p.T
                off = r["radius"] * length  # how far a query's product with a pivot can be from dot
                slack = 1e-9 * (length[r["cell"]] * length[cells] + off[cells] + r["norm"] * radius)
                reached = np.sort(np.nan_to_num(dot[of] - off[of] - r["norm"] * dists, nan=-np.inf))[::-1]
                # Scores are cut at the largest long: beyond it all are equal, and none may be left out.
                theta = min(max(reached[k] if len(reached) > k else -np.inf, r["reached"]), 2.0 ** 62)
                least = (theta - dot[cells] - off[cells] - slack) / r["norm"] if r["norm"] else np.full(len(cells), -np.inf)
                least = np.where(np.isnan(least), -np.inf, least)
            if n_held + r["n"] > group_queries:
                close()
                n_held = 0
            norm = float(theta / r["norm"] * (1 - 1e-9)) if theta > 0 and r["norm"] else -1.0
            held.append((r["cell"], parts_for(r["n"], group_queries), least, norm))
            n_held += r["n"]
        close()
    return groups, need


def _chain(p: np.ndarray, cells: list[int]) -> list[int]:
    """The cells in an order in which each is followed by the nearest one that is left."""
    left, out = np.array(cells, int), []
    while len(left):
        with np.errstate(all="ignore"):
            at = int(np.nan_to_num(((p[left] - p[out[-1]]) ** 2).sum(axis=1), nan=np.inf).argmin()) if out else 0
        out.append(int(left[at]))
        left = np.delete(left, at)
    return out
