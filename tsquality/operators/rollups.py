"""Hourly rollups (A1-A3) and how they are kept up to date (A4): by refreshes, or by a stream.

Refresh policy (fixed values): every hour, re-aggregate the buckets in
``[trunc(now - 3 h), trunc(now - 1 h))`` and replace them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsquality.functions.time import bucket
from tsquality.session import ROCKSDB_PROVIDER, settings

REFRESH_START_HOURS = 3
REFRESH_END_HOURS = 1


#: rollup -> what it groups by beside the hour, its measures
_ROLLUPS = {
    "gap_summary_hourly": ("meter_id", lambda: [
        F.count(F.lit(1)).alias("gap_count"), F.sum("gap_minutes").cast("bigint").alias("total_gap_minutes"),
        F.avg("gap_minutes").alias("avg_gap_minutes")]),
    "late_events_summary_hourly": ("meter_id", lambda: [
        F.count(F.lit(1)).alias("late_count"), F.avg("delay_seconds").alias("avg_delay_seconds"),
        F.max("delay_seconds").alias("max_delay_seconds")]),
    "metrics_summary_hourly": ("metric_type", lambda: [
        F.count(F.lit(1)).alias("event_count"), F.sum("value").alias("total_value"), F.avg("value").alias("avg_value")]),
}


def _rolled(df: DataFrame, rollup: str) -> DataFrame:
    key, measures = _ROLLUPS[rollup]
    return df.groupBy(bucket("1 hour", "time").alias("hour"), key).agg(*measures())


def gap_summary_hourly(gap_alerts: DataFrame) -> DataFrame:
    """A1."""
    return _rolled(gap_alerts, "gap_summary_hourly")


def late_events_summary_hourly(late_events: DataFrame) -> DataFrame:
    """A2."""
    return _rolled(late_events, "late_events_summary_hourly")


def metrics_summary_hourly(metrics: DataFrame) -> DataFrame:
    """A3."""
    return _rolled(metrics, "metrics_summary_hourly")


ROLLUPS = {
    "gap_summary_hourly": gap_summary_hourly,
    "late_events_summary_hourly": late_events_summary_hourly,
    "metrics_summary_hourly": metrics_summary_hourly,
}


def refresh_window(now: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    start = (now - dt.timedelta(hours=REFRESH_START_HOURS)).replace(minute=0, second=0, microsecond=0)
    end = (now - dt.timedelta(hours=REFRESH_END_HOURS)).replace(minute=0, second=0, microsecond=0)
    return start, end


def refresh(source: DataFrame, rollup: str, path: str, now: dt.datetime) -> DataFrame:
    """A4: recompute the refresh window of ``rollup`` from ``source`` and overwrite
    exactly those hour partitions under ``path`` (dynamic partition overwrite), so
    older buckets keep what they had when their window closed.
    """
    start, end = refresh_window(now)
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    src = source.where((F.col("time") >= lo) & (F.col("time") < hi))
    if "event_date" in source.columns:
        src = src.where(F.col("event_date").between(F.to_date(lo), F.to_date(hi)))
    out = ROLLUPS[rollup](src).withColumn("bucket_hour", F.date_format("hour", "yyyyMMddHH"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket_hour").parquet(path))
    return out


def as_refreshed(source: DataFrame, rollup: str, arrival: str = "arrival_ts") -> DataFrame:
    """What the hourly refresh leaves in ``rollup`` for a table filled over time.

    A bucket ``h`` is last refreshed at ``h + 3 h``; rows of that bucket written
    (``arrival``) after that moment are never aggregated. Equal to running
    :func:`refresh` at every full hour over the whole timeline.
    """
    return ROLLUPS[rollup](source.where(_in_time(arrival)))


def _in_time(arrival: str) -> Column:
    """Whether a row was written before its bucket's last refresh."""
    return F.col(arrival) < bucket("1 hour", "time") + F.make_dt_interval(F.lit(0), F.lit(REFRESH_START_HOURS))


def stream_rollup(rows: DataFrame, rollup: str, path: str, checkpoint: str, arrival: str = "arrival_ts",
                  available_now: bool = True, interval: str = "60 seconds"):
    """A4 as a stream: a rollup that is kept up to date by each micro-batch of ``rows`` (keyed tables: without
    repeated keys), which arrive in the order of ``arrival``.

    A bucket's state is an aggregate; a micro-batch writes the buckets that it changed, as they now are, to
    ``path`` by its batch id, and ``read_stream_rollup`` takes each bucket's latest. Rows written after their
    bucket's last refresh do not count, as in ``refresh``. The watermark runs those hours behind event
    time, which never runs before arrival, so it drops nothing that counts, and closes buckets for good.
    """
    key, measures = _ROLLUPS[rollup]
    spark = rows.sparkSession
    kept = rows.where(_in_time(arrival)).withWatermark("time", f"{REFRESH_START_HOURS} hours")
    out = kept.groupBy(F.window("time", "1 hour").alias("_w"), key).agg(*measures()).withColumn("hour", F.col("_w.start")).drop("_w")

    def write(df: DataFrame, batch_id: int) -> None:
        df.coalesce(1 + df.sparkSession.sparkContext.defaultParallelism // 8).write.mode("overwrite").parquet(f"{path}/_batch_id={batch_id}")
    w = out.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    with settings(spark, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
                          "spark.sql.shuffle.partitions": str(2 * spark.sparkContext.defaultParallelism)}):
        return w.start()


def read_stream_rollup(spark: SparkSession, path: str, rollup: str) -> DataFrame:
    """The buckets as the last micro-batch that changed them left them."""
    key, measures = _ROLLUPS[rollup]
    log = spark.read.option("basePath", path).parquet(path)
    values = [c for c in log.columns if c not in ("hour", key, "_batch_id")]
    last = F.max_by(F.struct(*values), F.col("_batch_id").cast("bigint"))
    return log.groupBy("hour", key).agg(last.alias("_v")).select("hour", key, "_v.*")
