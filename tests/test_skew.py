"""One meter holding more than a third of the rows: the routed run must give the
same tables when its hot segments are split over several tasks."""

import datetime as dt

from pyspark.sql import functions as F

from tsquality.config import QualityConfig
from tsquality.operators import tables as T
from tsquality.operators.sequence import detect_hot
from tsquality.plans.routing import route


def _rows(spark):
    base = dt.datetime(2024, 1, 1)
    rows = []
    seq = 0
    for i in range(900):                       # the hot meter: a reading every 2 minutes
        t = base + dt.timedelta(minutes=2 * i + (i % 7 == 0) * 45)
        arr = t + dt.timedelta(minutes=(i % 11 == 0) * 70)
        rows.append(("HOT", t, 1.0, seq, arr)); seq += 1
    for m in range(12):                        # quiet meters
        for i in range(60):
            t = base + dt.timedelta(minutes=30 * i + m, hours=(i % 9 == 0) * 2)
            rows.append((f"M{m}", t, 2.0, seq, t)); seq += 1
    return spark.createDataFrame(rows, "meter_id string, timestamp timestamp, consumption_kwh double, "
                                       "seq bigint, arrival_ts timestamp")


def _tables(r):
    out = {}
    for name, df, cols in [("validated", r.validated, ["time", "meter_id", "status"]),
                           ("alerts", T.resolve_routed(r.gap_alerts, "gap_alerts"),
                            ["meter_id", "missing_from", "missing_to", "gap_minutes", "detected_by"]),
                           ("late", r.late_events, ["meter_id", "time", "delay_seconds"]),
                           ("state", r.meter_state, ["meter_id", "last_seen", "gap_count", "late_count"])]:
        out[name] = sorted(map(tuple, df.select(*cols).collect()))
    return out


def test_hot_meter_is_split_and_results_agree(spark):
    raw = _rows(spark)
    plain = QualityConfig(interval_minutes=30, segment_seconds=6 * 3600, materialize="cache")
    split = plain.with_(max_segment_rows=40)
    hot = detect_hot(raw.withColumn("_bucket", F.unix_micros("arrival_ts")), "meter_id", split,
                     pos="_bucket", segment_us=6 * 3600 * 1_000_000)
    assert hot is not None and hot.where("meter_id = 'HOT'").count() > 0
    a = _tables(route(raw, plain, 600))
    b = _tables(route(raw, split, 600))
    assert a == b
    assert a["alerts"] and a["late"] and a["state"]


def test_one_bucket_of_one_meter_is_split(spark):
    """A backfill: all rows of a meter in one arrival bucket, some at one instant. The full order
    splits them; no part holds more than a few times the limit, and results agree."""
    import math

    from tsquality.operators.sequence import SEG, SUB, _apply_split
    base = dt.datetime(2024, 1, 1)
    arr = base + dt.timedelta(days=40)
    rows = [("HOT", base + dt.timedelta(minutes=30 * (i // 3) + (i % 50 == 0) * 100), 1.0, i, arr) for i in range(1000)]
    rows += [("Q", base + dt.timedelta(days=41, minutes=30 * i), 1.0, 2000 + i, arr + dt.timedelta(minutes=30 * i)) for i in range(20)]
    raw = spark.createDataFrame(rows, "meter_id string, timestamp timestamp, consumption_kwh double, seq bigint, "
                                      "arrival_ts timestamp")
    plain = QualityConfig(interval_minutes=30, materialize="cache")
    limit = 50
    d = raw.select("*", F.lit(7).cast("bigint").alias("_bucket"), F.unix_micros("timestamp").alias("_us"),
                   F.lit(0).cast("bigint").alias(SEG)).where("meter_id = 'HOT'")
    hot = detect_hot(d, "meter_id", plain.with_(max_segment_rows=limit))
    parts = _apply_split(d, "meter_id", ["_bucket", "_us", "seq"], hot).groupBy("meter_id", SEG, SUB).count().collect()
    assert sum(p["count"] for p in parts) == 1000 and len(parts) >= math.ceil(1000 / limit) * 0.7
    assert max(p["count"] for p in parts) <= 3 * limit
    assert _tables(route(raw, plain, 600)) == _tables(route(raw, plain.with_(max_segment_rows=limit), 600))
