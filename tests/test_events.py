"""The events adapter: as many tasks as the rows need, and draws compared by their digits."""

import datetime as dt

from pyspark.sql import functions as F

from tsquality.functions.hashing import below, digits, uniform01
from tsquality.sources import events


def _table(spark, tmp, rows):
    t0 = dt.datetime(2024, 1, 1)
    data = [(None if i % 50 == 7 else i % 300, None if i % 40 == 3 else t0 + dt.timedelta(minutes=i % 97), i % 11, float(i))
            for i in range(rows)]
    df = spark.createDataFrame(data, "event_id bigint, ts timestamp_ntz, user_id bigint, value double")
    df.coalesce(1).write.parquet(f"{tmp}/events.parquet")


def test_rows_of_one_file_are_dealt_to_many_tasks(spark, tmp, monkeypatch):
    _table(spark, tmp, 1000)
    plain = events.load_readings(spark, tmp)
    assert plain.rdd.getNumPartitions() == 1  # few rows stay where they are
    monkeypatch.setattr(events, "ROWS_PER_TASK", 100, raising=False)
    dealt = events.load_readings(spark, tmp)
    sizes = dealt.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == 10 and sum(sizes) == 1000 and max(sizes) < 300, sizes
    assert dealt.exceptAll(plain).count() == 0 == plain.exceptAll(dealt).count()


def test_digits_are_compared_as_their_numbers(spark):
    keys = spark.range(2000).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"))
    drawn = keys.select(digits(1, "s", "k").alias("d"), uniform01(1, "s", "k").alias("u")).cache()
    one = drawn.where("u IS NOT NULL").first().u
    for p in (-1.0, 0.0, 0.05, 0.5, one, one + 2.0 ** -52, 1.0 - 2.0 ** -52, 1.0, 1.5):
        assert drawn.where(~below(F.col("d"), p).eqNullSafe(F.col("u") < p)).count() == 0, p
