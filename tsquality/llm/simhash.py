"""SimHash near-duplicates by tiled exact comparison of fingerprints.

Equal fingerprints become one class first. For links at ``radius`` differing bits or fewer, the 64
bits are split into ``radius + 2`` blocks: two linked fingerprints agree on at least two whole
blocks, so each class joins one group per pair of blocks and every link lies inside a group. A
group is compared tile by tile: numpy exclusive-or and bit counts over all pairs of two tiles,
skipping pairs of tiles whose population counts differ beyond the radius. A group that is larger
than a tile is split by population count and hash, and its pairs of tiles are dealt to separate
tasks. A comparison returns a spanning forest, not all links. Components come from alternating
large-star and small-star rounds, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsquality.llm.common import lower_words, written

SEED = 42
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE = 256 * np.arange(8)
_WEIGHTS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned fingerprint: a bit is 1 if more than half of the shingles' XXH64 have it. 0 without words."""
    words = lower_words(text)
    if not words:
        return 0
    if len(words) < shingle:
        joined = [b" ".join(words)]
    else:
        joined = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    h = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in joined), np.uint64)
    codes = (h.view(np.uint8).reshape(-1, 8) + _BYTE).ravel()
    ones = np.einsum("bv,vk->bk", np.bincount(codes, minlength=2048).reshape(8, 256), _BITS).ravel()
    return int(_WEIGHTS[2 * ones > len(h)].sum(dtype=np.uint64))


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["id", "fp"])
    return run


def block_masks(radius: int) -> list[int]:
    """For each pair of the ``radius + 2`` blocks, the mask of its bits."""
    cuts = [64 * k // (radius + 2) for k in range(radius + 3)]
    blocks = [((1 << z) - 1) ^ ((1 << a) - 1) for a, z in zip(cuts, cuts[1:])]
    return [x | y for x, y in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(a: np.ndarray, b: np.ndarray | None, radius: int, side: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Links (x, y) that join what is linked among ``a``, or between ``a`` and ``b``: at most one a value."""
    every = a if b is None else np.concatenate([a, b])
    order = np.argsort(np.bitwise_count(every), kind="stable")
    fps, of_b = every[order], None if b is None else order >= len(a)
    counts = np.bitwise_count(fps).astype(int)
    label = np.arange(len(fps))
    starts = range(0, len(fps), side)
    tiles = [(i, j) for i in starts for j in starts
             if i <= j and counts[j] - counts[min(i + side, len(fps)) - 1] <= radius]
    changed = True
    while changed:
        changed, hit = False, []
        for i, j in tiles:
            x, y = slice(i, i + side), slice(j, j + side)
            near = np.bitwise_count(fps[x][:, None] ^ fps[y][None, :]) <= radius
            if of_b is not None:
                near &= of_b[x][:, None] != of_b[y][None, :]
            if i == j:
                np.fill_diagonal(near, False)
            if not near.any():
                continue
            hit.append((i, j))
            for rows, cols, m in ((x, y, near), (y, x, near.T)):
                least = np.where(m, label[cols][None, :], len(fps)).min(axis=1)
                own = label[rows]
                lower = least < own
                if lower.any():
                    changed = True
                    np.minimum.at(label, own[lower], least[lower])
            while not np.array_equal(up := label[label], label):
                label = up
        tiles = hit
    joined = np.flatnonzero(label != np.arange(len(fps)))
    return fps[joined], fps[label[joined]]


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _compared(radius: int):
    """mapInArrow function over rows sorted by task: links of each task's tiles."""
    def links(fps: np.ndarray, sides: np.ndarray):
        fps = fps.view(np.uint64)
        if sides[0] == 2:  # a whole group, or a tile with itself
            if len(fps) == 2:
                return (fps[:1], fps[1:]) if np.bitwise_count(fps[0] ^ fps[1]) <= radius else (fps[:0], fps[:0])
            return _forest(fps, None, radius)
        return _forest(fps[sides == 0], fps[sides == 1], radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            now = [b.column(c).to_numpy(zero_copy_only=False) for c in ("task", "fp", "side")]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            cuts = np.flatnonzero(np.diff(held[0])) + 1
            if len(cuts):  # all tasks but the last are complete
                yield out(held, [0, *cuts.tolist()])
                held = [x[cuts[-1]:] for x in held]
        if held is not None and len(held[0]):
            yield out(held, [0, len(held[0])])

    def out(held, cuts):
        found = [links(held[1][a:z], held[2][a:z]) for a, z in zip(cuts, cuts[1:]) if z - a > 1]
        sides = [np.concatenate([f[k] for f in found] or [np.empty(0, np.uint64)]).view(np.int64) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in sides], schema=_LINK)
    return run


def links(classes: DataFrame, radius: int, tile_rows: int = 4096) -> DataFrame:
    """Links a, b between the distinct fingerprints ``fp`` (BIGINT) that join all that are linked."""
    keys = F.array(*(F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v"))
                     for k, m in enumerate(block_masks(radius))))
    keyed = classes.select("fp", F.bit_count("fp").alias("ones"), F.explode(keys).alias("key")) \
        .select("fp", "ones", "key.k", "key.v")
    sizes = keyed.groupBy("k", "v", "ones").agg(F.count("*").alias("n")) \
        .groupBy("k", "v").agg(F.sum("n").alias("n"), F.collect_list(F.struct("ones", "n")).alias("by_ones")) \
        .where("n > 1")  # by_ones has at most 65 entries
    tiles = F.transform("by_ones", lambda x: F.struct(x["ones"].alias("ones"),
                                                      F.ceil(x["n"] / tile_rows).cast("int").alias("t")))
    d = keyed.join(sizes.withColumn("tiles", tiles).drop("by_ones"), ["k", "v"])
    small = d.where(F.col("n") <= tile_rows).select(
        F.xxhash64("k", "v").alias("task"), "k", "v", F.lit("").alias("pair"), "fp", F.lit(2).alias("side"))
    big = d.where(F.col("n") > tile_rows)
    own_t = F.element_at(F.filter("tiles", lambda x: x["ones"] == F.col("ones")), 1)["t"]
    big = big.withColumn("i", F.pmod(F.xxhash64("fp"), own_t).cast("int"))
    others = F.flatten(F.transform(
        F.filter("tiles", lambda x: F.abs(x["ones"] - F.col("ones")) <= radius),
        lambda x: F.transform(F.sequence(F.lit(0), x["t"] - 1), lambda j: F.struct(x["ones"].alias("o"), j.alias("j")))))
    big = big.select("k", "v", "fp", "ones", "i", F.explode(others).alias("x"))
    me, it = F.struct(F.col("ones").alias("o"), F.col("i").alias("j")), F.struct("x.o", "x.j")
    big = big.select("k", "v", F.concat_ws("/", F.least(me, it).cast("string"), F.greatest(me, it).cast("string"))
                     .alias("pair"), "fp", F.when(me == it, 2).when(me < it, 0).otherwise(1).alias("side"))
    big = big.select(F.xxhash64("k", "v", "pair").alias("task"), "k", "v", "pair", "fp", "side")
    dealt = small.unionAll(big).repartition("task").sortWithinPartitions("task", "k", "v", "pair")
    return dealt.select("task", "fp", "side").mapInArrow(_compared(radius), "a BIGINT, b BIGINT")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root (the least node of its component) of every node that is not itself the least."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e, before = written(e, "links"), None
    for _ in range(max_rounds):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = written(small.select("x.u", "x.v").where("u <> v").distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 2) -> DataFrame:
    """id, fp (BIGINT), component (the least id that links reach, itself included) of every row.

    A null or empty text has fingerprint 0, linked like any other. Repeated ids keep a row each;
    null ids are passed over by the least, which is null only where a whole component has no id.
    An empty table gives no row; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    fps = written(rows.mapInArrow(_fingerprints(shingle), "id BIGINT, fp BIGINT"), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    roots = components(links(classes.select("fp"), radius))
    classes = written(classes.join(roots, F.col("fp") == F.col("node"), "left")
                      .select("fp", "first", F.coalesce("root", "fp").alias("root")), "classes")
    least = classes.groupBy("root").agg(F.min("first").alias("component"))
    return fps.join(classes.join(least, "root").select("fp", "component"), "fp").select("id", "fp", "component")


def fingerprint_text(fp):
    """The fingerprint's 16 hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
