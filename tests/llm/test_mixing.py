"""Entropy balancing (4)."""

from collections import defaultdict

from pyspark.sql import functions as F

from tsquality.llm import mixing

from edge import documents, split, stored


def water(sizes, limit=3):
    names = sorted(sizes, key=lambda s: (s is None, "" if s is None else s))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, target, full = sum(sizes.values()), {}, set()
    for s in names:
        target[s] = total * weight[s] / sum(weight.values())
    while over := [s for s in names if s not in full and target[s] > limit * sizes[s] + 1e-9]:
        excess = 0
        for s in over:
            excess += target[s] - limit * sizes[s]
            target[s] = limit * sizes[s]
            full.add(s)
        free = [s for s in names if s not in full]
        for s in free:
            target[s] += excess * weight[s] / sum(weight[x] for x in free)
    return target


def check(docs, **options):
    got = mixing.mixed(docs, row=F.monotonically_increasing_id(), **options).collect()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "source").collect()
    size = {r.row: len(split(r.text)) for r in rows}
    source = {r.row: r.source for r in rows}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += size[r.row]
    target = water(sizes)
    assert len(got) == len(rows)
    for r in got:
        s = source[r.row]
        assert r["size"] == size[r.row] and r.source_size == sizes[s] and 0 <= r.taken <= 3 * r["size"]
        assert abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        taken[s] += r.taken
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.51, s
    return {(r.row, r.taken) for r in got}


def test_mix(spark, tmp):
    docs = stored(documents(spark), tmp, "documents")
    assert check(docs) == check(docs)  # reruns agree
    check(docs, part_rows=9)  # running rates over many parts


def test_capped_sources(spark, tmp):
    rows = [(i, "w " * (i % 7 + 1), f"s{i % 5}" if i % 11 else "big", ) for i in range(300)] + [(1000, "w " * 5000, "big")]
    docs = stored(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING"), tmp, "documents")
    check(docs)


def test_empty_texts_and_table(spark, tmp):
    rows = [(1, None, "a"), (2, "", "a"), (3, " ", None)]
    docs = stored(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING"), tmp, "documents")
    assert {(r.doc_id, r.taken, r.target) for r in mixing.mixed(docs).collect()} == {(1, 0, 0.0), (2, 0, 0.0), (3, 0, 0.0)}
    assert mixing.mixed(stored(documents(spark, empty=True), tmp, "none")).collect() == []


def test_rates_are_tilted(spark, tmp):
    """The dual's solution: rates are limit / (1 + (limit - 1) exp(-lam x)) and meet the target."""
    rows = [("a", s, n) for s, n in ((1, 50), (10, 20), (100, 3))]
    pairs = spark.createDataFrame(rows, "source STRING, size BIGINT, n BIGINT")
    for share in (0.2, 1.0, 2.5):
        total = sum(s * n for _, s, n in rows)
        sources = spark.createDataFrame([("a", total, total * share)], "source STRING, source_size BIGINT, target DOUBLE")
        r = mixing.solved(pairs, sources, 3).first()
        import math
        words = sum(n * s * 3 / (1 + 2 * math.exp(-r.lam * s / r["mean"])) for _, s, n in rows)
        assert abs(words - total * share) < 1e-6 * total
