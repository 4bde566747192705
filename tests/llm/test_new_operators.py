"""Importance resampling (11), vector codes (12) and decontamination (13) against plain versions."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from edge import CLASHING, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tsquality.llm import codes, decontaminate, resample
from tsquality.llm.spans import text_words

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return ALNUM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# -- words and checksums ------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZ9 .\n\0é日\U0001F600`{", max_size=30)), max_size=8), st.integers(1, 40))
def test_words_of_a_column(texts, together):
    import pyarrow as pa
    column = pa.array(["before", *texts], pa.string()).slice(1)
    from tsquality.llm import spans
    old, spans.TOGETHER = spans.TOGETHER, together
    try:
        got = [[w.data[a:z].tobytes().decode() for a, z in zip(w.starts[i:j], w.ends[i:j])]
               for _, w in text_words(column) for i, j in zip(w.first, w.first[1:])]
    finally:
        spans.TOGETHER = old
    assert got == [plain_words(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=300), st.lists(st.tuples(st.integers(0, 2000), st.integers(1, 9000)), min_size=1, max_size=20))
def test_checksums_of_spans(raw, spans):
    data = np.frombuffer(raw * 50, np.uint8)
    starts = np.array([a % len(data) for a, _ in spans])
    ends = np.minimum(starts + [n for _, n in spans], len(data))
    want = [zlib.crc32(data[a:z].tobytes()) for a, z in zip(starts, ends)]
    assert resample.span_crc32(data, starts, ends).tolist() == want


@pytest.mark.parametrize("length", [1, 63, 64, 65, 128, 129, 4096, 1_000_003])
def test_checksums_of_long_spans(length):
    data = np.random.default_rng(length).integers(0, 256, length + 5).astype(np.uint8)
    got = resample.span_crc32(data, np.array([0, 5, 2]), np.array([length, length + 5, 3]))
    assert got.tolist() == [zlib.crc32(data[:length].tobytes()), zlib.crc32(data[5:].tobytes()), zlib.crc32(data[2:3].tobytes())]


# -- importance resampling ----------------------------------------------------

def plain_resampled(docs, target, max_run=1, buckets=10_000, percent=10, min_words=20, seed="2024"):
    def ids(text):
        w = plain_words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, max_run + 1) for i in range(len(w) - n + 1)]
    s, t = np.zeros(buckets), np.zeros(buckets)
    for _, x in docs:
        np.add.at(s, ids(x), 1)
    for x in target:
        np.add.at(t, ids(x), 1)
    big_s, big_t = float(s.sum()), float(t.sum())
    out = []
    for k, (i, x) in enumerate(docs):
        own = ids(x)
        weight = sum(math.floor(1000 * math.log((t[j] + 1) * (big_s + buckets) / ((s[j] + 1) * (big_t + buckets)))) for j in own)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(own), weight, score, None, len(plain_words(x))])
    enough = [r for r in out if r[5] >= min_words]
    for k, r in enumerate(sorted(enough, key=lambda r: (-r[3], r[0] is None, r[0] or 0))[:len(enough) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


TARGET = ["the ing er on", "thething 12", None, "", "é " * 30, "x" * 500]


@pytest.mark.parametrize("options", [{}, {"max_run": 3, "buckets": 70_000, "percent": 50, "min_words": 1, "seed": "s"}])
def test_resampling_equals_plain(spark, options):
    docs = documents(spark)
    target = spark.createDataFrame([(x,) for x in TARGET], "text STRING")
    got = sorted((tuple(r) for r in resample.resampled(docs, target, **options).collect()), key=str)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got == plain_resampled(rows, TARGET, **options)


def test_ranks_over_many_partitions(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("v"), "id")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = sorted((r["rank"], r["v"], r["id"]) for r in resample.ranked(rows, order, 1000, part_rows=90).collect())
    assert got == [(k + 1, v, i) for k, (v, i) in enumerate(sorted(((i % 7, i) for i in range(1000)), key=lambda x: (-x[0], x[1])))]


def test_resampling_of_empty_tables(spark):
    none = documents(spark, empty=True)
    target = spark.createDataFrame([(x,) for x in TARGET], "text STRING")
    assert resample.resampled(none, target).collect() == []
    rows = [(r.doc_id, r.text) for r in documents(spark, 20).select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in resample.resampled(documents(spark, 20), target.limit(0)).collect()), key=str)
    assert got == plain_resampled(rows, [])


# -- vector codes -------------------------------------------------------------

def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [(i, label, [math.floor(scale * float(np.float32(x))) for x in v]) for i, label, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for dim in {len(v) for _, _, v in kept}:
        own = sorted((r for r in kept if len(r[2]) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
        cut = codes.cuts(dim, parts)
        books = [[r[2][a:z] for r in own[:entries]] for a, z in cut]

        def far(x, c):
            return sum((a - b) ** 2 for a, b in zip(x, c))

        def near(x, book):
            return min((far(x, c), k) for k, c in enumerate(book))
        for _ in range(rounds):
            for p, (a, z) in enumerate(cut):
                held = {}
                for r in own:
                    held.setdefault(near(r[2][a:z], books[p])[1], []).append(r[2][a:z])
                books[p] = [[sum(y) // len(held[k]) for y in zip(*held[k])] if k in held else c for k, c in enumerate(books[p])]
        digest = hashlib.sha256(",".join(str(y) for book in books for c in book for y in c).encode()).hexdigest()
        for i, label, v in own:
            best = [near(v[a:z], books[p]) for p, (a, z) in enumerate(cut)]
            out.append([i, "".join(f"{k:02x}" for _, k in best), min(sum(d for d, _ in best), codes._LONG), label, digest])
    total = {}
    for r in out:
        total[r[3]] = total.get(r[3], 0) + r[2]
    return sorted(((i, c, e, min(total[label], codes._LONG), d) for i, c, e, label, d in out), key=str)


def vectors(spark, rows):
    df = spark.createDataFrame([(i, label, v) for i, label, v in rows], "vec_id BIGINT, label INT, embedding ARRAY<FLOAT>")
    return df.repartition(3).select("*", *(F.lit("x").alias(c) for c in CLASHING if c != "label"), F.lit(1).alias("v"), F.lit(2).alias("code"))


def test_codes_equal_plain(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 3 if i % 5 else None, rng.normal(size=8).round(2).tolist()) for i in range(330)]
    rows += [(i, 1, rows[0][2]) for i in range(400, 500)]  # one vector many times
    rows += [(600, 1, None), (601, 1, [1.0, None] + [0.0] * 6), (602, 1, [float("nan")] * 8), (603, 1, [float("-inf")] * 8),
             (None, 2, rows[1][2]), (5, 2, rows[5][2]), (5, 2, rows[6][2]), (604, 2, [-0.0] * 8),
             (700, 2, [1.0, 2.0, 3.0]), (701, 2, [1.5, 2.0, 3.0]), (702, None, [])]
    got = sorted((tuple(r) for r in codes.coded(vectors(spark, rows)).collect()), key=str)
    assert got == plain_codes(rows)


@pytest.mark.parametrize("options", [{"parts": 2, "entries": 5, "rounds": 3}, {"parts": 3, "entries": 1, "rounds": 0, "scale": 10}])
def test_codes_of_other_sizes_and_large_numbers(spark, options):
    rng = np.random.default_rng(4)
    rows = [(i, 0, (rng.normal(size=6) * 10.0 ** rng.integers(0, 30)).astype(np.float32).tolist()) for i in range(60)]
    got = sorted((tuple(r) for r in codes.coded(vectors(spark, rows), **options).collect()), key=str)
    assert got == plain_codes(rows, **options)


def test_codes_of_an_empty_table(spark):
    assert codes.coded(vectors(spark, [])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 4), st.integers(1, 6), st.integers(0, 1 << 30))
def test_search_is_exact_with_ties(size, width, spread, seed):
    rng = np.random.default_rng(seed)
    entries, x = rng.integers(0, spread, (size, width)), rng.integers(0, spread, (200, width))
    best, far = codes.Codebook(entries).nearest(x)
    apart = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (best == apart.argmin(axis=1)).all() and (far == apart.min(axis=1)).all()


# -- decontamination ----------------------------------------------------------

def plain_hits(docs, items, window=10):
    """(doc_id, words, hit positions, items) of every document."""
    wins = {}
    for i, t in items:
        w = plain_words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add(i)
    lengths = {len(x) for x in wins}
    for i, t in docs:
        w = plain_words(t)
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if own := wins.get(tuple(w[k:k + n])):
                    hit |= set(range(k, k + n))
                    found |= own
        yield i, w, hit, found


def plain_contaminated(docs, items, window=10):
    out = []
    for i, w, hit, found in plain_hits(docs, items, window):
        names = ",".join(sorted("" if x is None else str(x) for x in found))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def cases(spark):
    docs = documents(spark)
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    from edge import split
    w = [x.decode() for x in split(rows[7])] * 3
    long = [x.decode() for x in split(rows[103])]
    items = [(1, " ".join(w[:12])), (2, " ".join(w[3:20]).upper()), (10, "THE  the!"), (11, "same line here"), (3, None), (4, ""), (5, "... \n"),
             (6, " ".join(long[:25_000])), (6, "one, two"), (None, "below zero"), (None, "12 34"), (7, " ".join(w[:12])),
             (8, "日本語"), (9, "x" * 10_000), (12, "never there at all in any of these texts whatever")]
    items = spark.createDataFrame(items, "item_id BIGINT, text STRING").select("*", *(F.lit("x").alias(c) for c in ("item", "n", "words", "row")))
    return docs, items.repartition(2)


@pytest.mark.parametrize("options", [{}, {"slice_bytes": 100_000, "piece_words": 700}, {"window": 3}])
def test_contaminated_equals_plain(spark, options):
    docs, items = cases(spark)
    got = sorted((tuple(r) for r in decontaminate.contaminated(docs, items, **options).collect()), key=str)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = plain_contaminated(rows, [(r.item_id, r.text) for r in items.select("item_id", "text").collect()], options.get("window", 10))
    assert got == want and sum(r[5] for r in want) >= 5


def test_slices_are_bounded_and_hold_every_window(spark):
    _, items = cases(spark)
    sets = decontaminate.window_sets(items, 10, "item_id", "text", 100_000, 700)
    assert len(sets) > 5
    windows = [w for s in sets for _, n, t in s.collect() for t in [t.decode().split(" ")] for w in zip(*(t[k:] for k in range(n)))]
    want = [w for r in items.collect() for t in [plain_words(r.text)] if t
            for w in zip(*(t[k:] for k in range(min(10, len(t)))))]
    assert set(windows) == set(want)


@pytest.mark.parametrize("options", [{}, {"slice_bytes": 100_000, "piece_words": 700}])
def test_spans_or_documents_are_removed(spark, options):
    docs, items = cases(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    hits = list(plain_hits(rows, [(r.item_id, r.text) for r in items.collect()]))
    kept = decontaminate.decontaminated(docs, items, remove="documents", **options)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, plain_words(r.text)) for r in kept.collect()), key=str) == \
        sorted(((i, w) for i, w, hit, _ in hits if not hit), key=str)
    cut = decontaminate.decontaminated(docs, items, **options)
    assert cut.columns == docs.columns
    left = sorted(((r.doc_id, plain_words(r.text)) for r in cut.collect()), key=str)
    assert left == sorted(((i, [x for k, x in enumerate(w) if k not in hit]) for i, w, hit, _ in hits), key=str)
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[107] == " \U0001F600" and texts[100] is None and texts[101] == "" and texts[102] == " \n\t"


def test_decontamination_of_empty_tables(spark):
    docs, items = cases(spark)
    assert decontaminate.contaminated(docs.limit(0), items).collect() == []
    rows = decontaminate.contaminated(docs, items.limit(0)).collect()
    assert len(rows) == docs.count() and not any(r.contaminated or r.n_hit or r.n_items for r in rows)
    with pytest.raises(ValueError):
        decontaminate.decontaminated(docs, items, remove="words")


def test_equal_hashes_of_other_words_do_not_hit(spark, monkeypatch):
    """Verification decides: with a hash that is always the same, the result is the same."""
    import pyarrow as pa
    monkeypatch.setattr(decontaminate, "word_hashes", lambda words: np.zeros(len(words), np.uint64))
    monkeypatch.setattr(decontaminate, "window_hashes", lambda h, n: np.zeros(max(0, len(h) - n + 1), np.uint64))
    own = decontaminate.WindowSet([("a", 2, b"x y"), ("b", 2, b"y z"), ("c", 1, b"q")])
    (_, words), = text_words(pa.array(["x y z", "z x", "Q y"]))
    got = sorted((w, n, tuple(own.items[i] for i in items)) for w, n, items in own.hits(words))
    assert got == [(0, 2, ("a",)), (1, 2, ("b",)), (5, 1, ("c",))]
