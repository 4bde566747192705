"""Hourly rollups and the incremental refresh policy (A1-A4)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tsquality.operators import rollups as R

from helpers import ts


def test_refresh_window():
    assert R.refresh_window(ts("2024-01-01 10:20:00")) == (ts("2024-01-01 07:00:00"), ts("2024-01-01 09:00:00"))


def test_hourly_refresh_equals_as_refreshed(spark, tmp):
    rows = []
    base = ts("2024-01-01 00:00:00")
    for i in range(60):
        t = base + dt.timedelta(minutes=17 * i)
        arrival = t + dt.timedelta(minutes=(i % 7) * 45)
        rows.append((t, f"M{i % 3}", t, 1.0, 100 + i, arrival))
    late = spark.createDataFrame(rows, "time timestamp, meter_id string, event_timestamp timestamp, "
                                       "consumption_kwh double, delay_seconds int, arrival_ts timestamp")
    path = os.path.join(tmp, "rollup")
    now = base
    while now <= base + dt.timedelta(hours=24):
        seen = late.where(F.col("arrival_ts") < F.lit(now).cast("timestamp"))
        R.refresh(seen, "late_events_summary_hourly", path, now)
        now += dt.timedelta(hours=1)
    got = spark.read.parquet(path).drop("bucket_hour")
    want = R.as_refreshed(late, "late_events_summary_hourly")
    cols = ["hour", "meter_id", "late_count", "avg_delay_seconds", "max_delay_seconds"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_streamed_rollup_equals_hourly_refresh(spark, tmp):
    """Rows arrive in the order of their arrival, some after their bucket's last refresh; a stop in between changes nothing."""
    from tsquality.sources.replay import write_after
    base, rows = ts("2024-01-01 00:00:00"), []
    for i in range(80):
        t = base + dt.timedelta(minutes=17 * i)
        rows.append((t, f"M{i % 3}", 100 + i, t + dt.timedelta(minutes=(i % 9) * 40)))
    rows.sort(key=lambda r: r[3])
    schema = "time timestamp, meter_id string, delay_seconds int, arrival_ts timestamp"
    src, out, ckpt = (os.path.join(tmp, x) for x in ("src", "out", "ckpt"))
    newest = 0
    for part in (0, 1):
        for k in range(4):
            at = 40 * part + 10 * k
            newest = write_after(spark.createDataFrame(rows[at:at + 10], schema).coalesce(1), f"{src}/chunk={part}{k}", newest)
        stream = spark.readStream.schema(schema + ", chunk STRING").option("maxFilesPerTrigger", 1).parquet(src).drop("chunk")
        R.stream_rollup(stream, "late_events_summary_hourly", out, ckpt).awaitTermination()
    got = R.read_stream_rollup(spark, out, "late_events_summary_hourly")
    want = R.as_refreshed(spark.createDataFrame(rows, schema), "late_events_summary_hourly")
    cols = ["hour", "meter_id", "late_count", "avg_delay_seconds", "max_delay_seconds"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert sum(r.late_count for r in got.collect()) < len(rows)
