"""Lateness classification (FIXTURES 3, watermark 14:00:00) and the batch watermark."""

from pyspark.sql import functions as F

from tsquality.config import DEFAULT
from tsquality.operators.lateness import arrival_batches, calculate_delay, classify_event, with_bucket

from helpers import readings, ts

CASES = [("2024-01-01 14:00:00", "ON_TIME", None), ("2024-01-01 14:30:00", "ON_TIME", None),
         ("2024-01-01 13:59:59.500000", "LATE", 0), ("2024-01-01 13:00:00", "LATE", 3600),
         ("2024-01-01 12:59:59.900000", "TOO_LATE", 3600), ("2024-01-01 11:00:00", "TOO_LATE", 10800)]


def test_classify(spark):
    df = spark.createDataFrame([(ts(t),) for t, _, _ in CASES], "t timestamp")
    wm = F.unix_micros(F.lit(ts("2024-01-01 14:00:00")).cast("timestamp"))
    got = df.select("t", classify_event(F.unix_micros("t"), wm, DEFAULT).alias("c"),
                    calculate_delay(F.unix_micros("t"), wm).alias("d")).collect()
    by_t = {r.t: (r.c, r.d) for r in got}
    for t, c, d in CASES:
        cls, delay = by_t[ts(t)]
        assert cls == c, t
        if c == "TOO_LATE" or c == "LATE":
            assert delay == d, t


def test_no_watermark_is_on_time(spark):
    df = spark.createDataFrame([(ts("2024-01-01 11:00:00"),)], "t timestamp")
    r = df.select(classify_event(F.unix_micros("t"), F.lit(None).cast("bigint"), DEFAULT).alias("c")).first()
    assert r.c == "ON_TIME"


def test_batch_watermark_is_max_of_earlier_batches(spark):
    rows = readings(spark, [("a", "2024-01-01 10:00:00", 1.0, "2024-01-01 10:00:00"),
                            ("b", "2024-01-01 14:00:00", 1.0, "2024-01-01 11:00:00"),
                            ("b", "2024-01-01 14:30:00", 1.0, "2024-01-01 12:00:00"),
                            ("a", "2024-01-01 11:00:00", 1.0, "2024-01-01 13:00:00")])
    rows = with_bucket(rows.withColumn("error", F.lit(None).cast("string")), 3600)
    b = {r._bucket: r.wm_us for r in arrival_batches(rows, DEFAULT).collect()}
    ks = sorted(b)
    assert b[ks[0]] is None
    assert [b[k] for k in ks[1:]] == [int(ts(x).replace(tzinfo=__import__("datetime").timezone.utc).timestamp()
                                          * 1_000_000) for x in ("2024-01-01 10:00:00", "2024-01-01 14:00:00",
                                                                 "2024-01-01 14:30:00")]
