"""Benchmark decontamination by exact n-gram windows.

A window is ``window`` consecutive words of a benchmark item; an item of fewer words, but not none, is
one window. A document's word inside any occurrence of a window is hit.

The items' windows become a hash set that is broadcast: sorted 64-bit hashes by window length, a bitmap
of their leading bits before them, and beside each hash where its words stand in the items' text and
which items have them. What is broadcast is checked: the items' sizes are summed up first, and items
beyond ``slice_bytes`` are cut into slices, each scanned for on its own, so that no task ever holds
more than one. An item longer than ``piece_words`` is cut into pieces that overlap by a window less one.

Documents are scanned in place. A word's hash is a sum over its bytes, folded for many texts at once; a
window's hash comes from running sums of word hashes, so its length costs nothing. Windows whose hash is
in the set are verified: their words are compared, byte by byte, with the item's. So no hash decides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsquality.llm.common import parts_for, written
from tsquality.llm.spans import Words, positions, text_words

_U = np.uint64
#: A word's byte b at distance d from the end contributes b * FACTOR ** d (distances modulo 64), and a
#: window's words are weighed by powers of STEP; both are odd, so powers of STEP have inverses.
_FACTOR, _STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Words hashed at once, which bounds the arrays made for them; a window is no longer.
_BLOCK = 1 << 18
#: What the set takes for each byte of an item's text, at most: words have a byte and a separator at
#: least, and each has a hash, two places and an item number.
_BYTES_EACH = 24

_PIECES = "item STRING, n BIGINT, words BINARY"
_FOUND = pa.schema([("n_words", pa.int64()), ("items", pa.list_(pa.string())),
                    ("runs", pa.list_(pa.struct([(n, pa.int64()) for n in ("word", "to_word", "byte", "to_byte")])))])
_FOUND_DDL = ("n_words BIGINT, items ARRAY<STRING>, "
              "runs ARRAY<STRUCT<word: BIGINT, to_word: BIGINT, byte: BIGINT, to_byte: BIGINT>>")


@lru_cache(maxsize=1)
def _byte_table() -> np.ndarray:
    powers = np.multiply.accumulate(np.full(64, _FACTOR, _U))
    return (powers[:, None] * (np.arange(256, dtype=_U) + _U(1))[None, :]).ravel()


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of STEP, and their inverses."""
    inverse = pow(_STEP, -1, 1 << 64)
    return tuple(np.append(_U(1), np.multiply.accumulate(np.full(2 * _BLOCK, x, _U))) for x in (_STEP, inverse))


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word."""
    out = np.empty(len(words), _U)
    for at in range(0, len(words), _BLOCK):
        starts = words.starts[at:at + _BLOCK]
        lengths = words.ends[at:at + _BLOCK] - starts
        pos, first = positions(starts, lengths)
        from_end = np.repeat(first + lengths - 1, lengths) - np.arange(len(pos))
        out[at:at + _BLOCK] = np.add.reduceat(_byte_table()[(from_end & 63) << 8 | words.data[pos]], first)
    out ^= out >> _U(29)
    out *= _U(0xBF58476D1CE4E5B9)
    return out ^ out >> _U(32)


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """The hash of the ``length`` words from each word on, as far as there are so many: by running sums
    modulo 2^64, a block of words after the other."""
    powers, inverse = _powers()
    out = np.empty(max(0, len(hashes) - length + 1), _U)
    for at in range(0, len(out), _BLOCK):
        own = hashes[at:at + _BLOCK + length - 1]
        sums = np.append(_U(0), np.cumsum(own * powers[:len(own)], dtype=_U))
        n = len(own) - length + 1
        out[at:at + n] = (sums[length:] - sums[:n]) * inverse[:n]
    return out ^ out >> _U(31)


def _joined(words: Words, a: int, z: int) -> bytes:
    """The words ``a`` to ``z`` joined by a space each."""
    return b" ".join(filter(None, words.data[words.starts[a]:words.ends[z - 1]].tobytes().split(b"\0")))


class WindowSet:
    """The windows of some items' pieces: (item, window length, words joined by spaces)."""

    def __init__(self, pieces: list[tuple[str | None, int, bytes]]):
        self.items = sorted({i for i, _, _ in pieces}, key=lambda i: (i is not None, i))
        number = {i: k for k, i in enumerate(self.items)}
        by_length: dict[int, list] = defaultdict(list)
        for item, n, text in pieces:
            by_length[n].append((number[item], text))
        self.tables = {n: self._table(n, own) for n, own in by_length.items()}

    @staticmethod
    def _table(n: int, pieces: list[tuple[int, bytes]]) -> tuple:
        blob = b" ".join(t for _, t in pieces)
        data = np.frombuffer(blob, np.uint8)
        cut = np.flatnonzero(data == ord(" "))
        words = Words(data, np.append(0, cut + 1), np.append(cut, len(data)), None, None)
        hashes = window_hashes(word_hashes(words), n)
        counts = np.array([t.count(b" ") + 1 for _, t in pieces])
        of = np.repeat(np.arange(len(pieces)), counts)
        at = np.flatnonzero(of[:len(hashes)] == of[n - 1:])  # windows that lie in one piece
        item = np.array([i for i, _ in pieces])[of[at]]
        order = np.lexsort((item, hashes[at]))
        at, item, h = at[order], item[order], hashes[at][order]
        bits = min(27, max(16, (32 * len(h)).bit_length()))
        there = np.zeros(1 << bits, bool)
        there[h >> _U(64 - bits)] = True
        return h, words.starts[at], words.ends[at + n - 1], item.astype(np.int32), blob, bits, there

    def hits(self, words: Words) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first word, length, item numbers) of each verified window; ``words`` may be of several texts."""
        hashes = word_hashes(words)
        for n, (h, starts, ends, item, blob, bits, there) in self.tables.items():
            found = window_hashes(hashes, n)
            at = np.flatnonzero(there[found >> _U(64 - bits)])
            at = at[np.searchsorted(words.first, at, "right") == np.searchsorted(words.first, at + n - 1, "right")]
            a, z = np.searchsorted(h, found[at]), np.searchsorted(h, found[at], "right")
            same = a < z
            for w, k, end in zip(at[same].tolist(), a[same].tolist(), z[same].tolist()):
                text = _joined(words, w, w + n)
                own = {k} if end == k + 1 else range(k, end)
                items = [int(item[j]) for j in own if blob[starts[j]:ends[j]] == text]
                if items:
                    yield w, n, items


def _pieces(window: int, piece_words: int):
    """mapInArrow function: (item, text) to pieces of at most ``piece_words`` words, each window in one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            item, n, out = [], [], []
            ids = b.column("item").to_pylist()
            for t, words in text_words(b.column("text")):
                for k, (a, z) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
                    if a == z:
                        continue
                    own = min(window, z - a)
                    for p in range(a, z - own + 1, piece_words):
                        item.append(ids[t + k])
                        n.append(own)
                        out.append(_joined(words, p, min(z, p + piece_words + own - 1)))
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(n, pa.int64()), pa.array(out, pa.binary())],
                                             names=["item", "n", "words"])
    return run


def _runs(covered: np.ndarray, words: Words, text: int) -> list[dict]:
    """The maximal runs of hit words of one text: words and bytes, counted from the text's own first."""
    a, begin = words.first[text], words.begin[text]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    return [{"word": int(x), "to_word": int(y), "byte": int(words.starts[a + x] - begin), "to_byte": int(words.ends[a + y - 1] - begin)}
            for x, y in zip(edge[0::2], edge[1::2])]


def _scanned(shared, all_rows: bool):
    """mapInArrow function: (row, id, text) to what is hit. Rows without a hit are left out unless ``all_rows``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for b in batches:
            taken, out = [], []
            for t, words in text_words(b.column("text")):
                hits, items = np.zeros(len(words) + 1, np.int64), defaultdict(set)
                for w, n, own in windows.hits(words):
                    hits[w] += 1
                    hits[w + n] -= 1
                    items[int(np.searchsorted(words.first, w, "right")) - 1].update(own)
                covered = np.cumsum(hits)[:-1] > 0
                for k, n in enumerate(np.diff(words.first).tolist()):
                    if k in items:
                        a = words.first[k]
                        out.append({"n_words": n, "items": [windows.items[i] for i in sorted(items[k])],
                                    "runs": _runs(covered[a:a + n], words, k)})
                    elif all_rows:
                        out.append({"n_words": n, "items": [], "runs": []})
                    else:
                        continue
                    taken.append(t + k)
            keys = b.select(["row", "id"]).take(pa.array(taken, pa.int64()))
            found = pa.RecordBatch.from_pylist(out, schema=_FOUND)
            yield pa.RecordBatch.from_arrays([*keys.columns, *found.columns], names=["row", "id", *_FOUND.names])
    return run


def _merged(runs):
    """Runs of hit words of several scans as maximal runs, as a column."""
    ordered = F.array_sort(runs)
    empty = F.slice(ordered, 1, 0)

    def add(done, x):
        last = F.element_at(done, -1)
        longer = F.struct(last["word"].alias("word"), F.greatest(last["to_word"], x["to_word"]).alias("to_word"),
                          last["byte"].alias("byte"), F.greatest(last["to_byte"], x["to_byte"]).alias("to_byte"))
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["to_word"] >= x["word"]), grown) \
            .otherwise(F.concat(done, F.array(x)))
    return F.aggregate(ordered, empty, add)


def window_sets(items: DataFrame, window: int, id_col: str, text_col: str, slice_bytes: int, piece_words: int) -> list[DataFrame]:
    """The pieces of the items, in as many tables as keep what each makes of them under ``slice_bytes``."""
    given = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    pieces = written(given.mapInArrow(_pieces(window, piece_words), _PIECES).distinct(), "windows")
    size = pieces.agg(F.sum(F.octet_length("words") + 64)).first()[0]
    n = parts_for((size or 0) * _BYTES_EACH, slice_bytes)
    return [pieces.where(F.pmod(F.xxhash64("item", "n", "words"), F.lit(n)) == s) for s in range(n)]


def scanned(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", item_col: str = "item_id",
            text_col: str = "text", item_text_col: str = "text", slice_bytes: int = 128 << 20,
            piece_words: int = 50_000) -> DataFrame:
    """id, n_words, items, runs for each document: the ids, as text, of the items that have a window in it
    (each once, a null id as null), and the maximal runs of hit words (from word, to word, from byte, to
    byte of the text in UTF-8; ends excluded).

    Null and wordless texts have no words and no hits; items without words have no windows; rows of
    ``items`` with one id, or with none, count as one item. Repeated documents have a row each. Texts of
    any length are scanned whole. Without documents there are no rows, without items no hits. Other
    columns are not read.
    """
    spark = docs.sparkSession
    sets = window_sets(items, window, item_col, item_text_col, slice_bytes, piece_words)
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                        F.monotonically_increasing_id().alias("row"))
    if len(sets) > 1:  # all scans must see the same numbers
        given = written(given, "numbered")
    ddl = f"row BIGINT, id {docs.schema[id_col].dataType.simpleString()}, {_FOUND_DDL}"
    out = None
    for k, own in enumerate(sets):
        shared = spark.sparkContext.broadcast(WindowSet([tuple(r) for r in own.collect()]))  # under slice_bytes, see above
        found = given.mapInArrow(_scanned(shared, all_rows=k == 0), ddl)
        out = found if out is None else out.unionByName(found)
    if len(sets) > 1:
        out = out.groupBy("row").agg(F.max("id").alias("id"), F.max("n_words").alias("n_words"),
                                     F.flatten(F.collect_list("items")).alias("items"),
                                     F.flatten(F.collect_list("runs")).alias("runs"))
        out = out.select("id", "n_words", F.array_distinct("items").alias("items"), _merged("runs").alias("runs"))
    return out.select("id", "n_words", "items", "runs")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text, runs) to (row, text) without the runs' bytes."""
    for b in batches:
        out = []
        for text, runs in zip(b.column("text"), b.column("runs")):
            raw, kept, at = text.as_py().encode(), [], 0
            for r in runs.as_py():
                kept.append(raw[at:r["byte"]])
                at = r["to_byte"]
            out.append(b"".join([*kept, raw[at:]]).decode())
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, pa.string())], names=["row", "text"])


def decontaminated(docs: DataFrame, items: DataFrame, remove: str = "spans", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without what is hit: without the runs of hit words (``remove="spans"``; what stands between
    words outside the runs stays), or without the documents that have a hit (``remove="documents"``).

    All columns stay, whatever their names; rows without a hit stay as they are. See ``scanned`` for
    nulls, empty texts, repeated rows and empty tables.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is 'spans' or 'documents', not {remove!r}")
    row, cleaned = "row_number_", "cleaned_"
    taken = {c.lower() for c in docs.columns}
    while row in taken or cleaned in taken:
        row, cleaned = row + "_", cleaned + "_"
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    hit = scanned(rows, items, id_col=row, text_col=text_col, **options).where(F.size("runs") > 0)
    if remove == "documents":
        return rows.join(hit.select(F.col("id").alias(row)), row, "left_anti").drop(row)
    hit = hit.select(F.col("id").alias(row), "runs")
    texts = rows.select(row, F.col(f"`{text_col}`").cast("string").alias("text")).join(hit, row)
    texts = texts.select(F.col(row).alias("row"), "text", "runs").mapInArrow(_without, "row BIGINT, text STRING")
    texts = texts.select(F.col("row").alias(row), F.col("text").alias(cleaned))
    new = F.coalesce(F.col(cleaned), F.col(f"`{text_col}`"))
    return rows.join(texts, row, "left").withColumn(text_col, new).select(*(F.col(f"`{c}`") for c in docs.columns))


def contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document; see ``scanned``.

    ``items_sha256`` is of the ids in the order of strings, joined by commas (a null id as the empty string
    there; no items: of the empty string).
    """
    n_hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + r["to_word"] - r["word"])
    names = F.array_join(F.array_sort(F.transform("items", lambda i: F.coalesce(i, F.lit("")))), ",")
    return scanned(docs, items, **options).select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (F.size("runs") > 0).alias("contaminated"))
