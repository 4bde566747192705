"""The skew-safe ordered scan equals a plain per-key window, with and without hot-segment splits."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tsquality.config import DEFAULT
from tsquality.operators.sequence import ordered_scan


def _check(spark, data, cfg, seg):
    df = spark.createDataFrame(data, "k string, pos bigint, v bigint, seq bigint")
    got = ordered_scan(df, "k", "pos", ["pos", "seq"],
                       [("pm", "prev_max", "v"), ("pv", "prev", "v"), ("nx", "next", "v")], cfg, segment_us=seg)
    w = Window.partitionBy("k").orderBy("pos", "seq")
    want = df.select("k", "pos", "v", "seq",
                     F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("pm"),
                     F.lag("v").over(w).alias("pv"), F.lead("v").over(w).alias("nx"))
    cols = ["k", "pos", "v", "seq", "pm", "pv", "nx"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_hot_key_split(spark):
    rnd = random.Random(3)
    data = [("hot", rnd.randrange(0, 1000), rnd.randrange(-50, 50), i) for i in range(3000)]
    data += [(f"k{j}", rnd.randrange(0, 1000), rnd.randrange(-50, 50), 10_000 + j) for j in range(300)]
    _check(spark, data, DEFAULT.with_(max_segment_rows=100), 200)
    _check(spark, data, DEFAULT, 200)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 50), st.integers(-9, 9)),
                min_size=1, max_size=60))
def test_random_sequences(spark, rows):
    data = [(k, p, v, i) for i, (k, p, v) in enumerate(rows)]
    _check(spark, data, DEFAULT.with_(max_segment_rows=3), 10)
