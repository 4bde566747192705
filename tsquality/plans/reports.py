"""Report queries over the result tables.

Each takes the tables it reads plus an explicit time range / ``now`` (so results
are testable; pass ``current_timestamp()`` semantics by giving the real time)
and an optional meter (``None`` = all meters). Buckets are never aliased to an
input column's name (SURVEY D12), and the late percentage buckets both sides
(D13). When a table carries the ``event_date`` partition column, the time range
is also applied to it so that Spark prunes partitions.

Status bands of the active-meter tile (fixed values): red below 10, yellow from
10, green from 50 active meters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsquality.functions.time import bucket


def _ts(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.lit(x).cast("timestamp")


def time_filter(df: DataFrame, t_from, t_to, col: str = "time") -> DataFrame:
    """``col BETWEEN t_from AND t_to`` (+ the matching ``event_date`` range)."""
    out = df.where(F.col(col).between(_ts(t_from), _ts(t_to)))
    if "event_date" in df.columns and col == "time":
        out = out.where(F.col("event_date").between(F.to_date(_ts(t_from)), F.to_date(_ts(t_to))))
    return out


def since(df: DataFrame, now, hours: int, col: str = "time") -> DataFrame:
    """``col >= now - hours``."""
    lo = _ts(now) - F.make_dt_interval(F.lit(0), F.lit(hours))
    out = df.where(F.col(col) >= lo)
    if "event_date" in df.columns and col == "time":
        out = out.where(F.col("event_date") >= F.to_date(lo))
    return out


def meter_filter(df: DataFrame, meter_id: str | None) -> DataFrame:
    """All meters, or one."""
    return df if meter_id is None else df.where(F.col("meter_id") == F.lit(meter_id))


def status_band(n: Column) -> Column:
    """P10."""
    return (F.when(n >= F.lit(50), F.lit("green")).when(n >= F.lit(10), F.lit("yellow"))
            .otherwise(F.lit("red")))


# -- data quality overview -------------------------------------------------

def active_meter_count(validated: DataFrame, now, hours: int = 24) -> DataFrame:
    """A5 + P10: distinct meters with a reading in the last ``hours``."""
    n = since(validated, now, hours).agg(F.count_distinct("meter_id").alias("value"))
    return n.select("value", status_band(F.col("value")).alias("status"))


def events_per_minute(validated: DataFrame, t_from, t_to) -> DataFrame:
    """A6."""
    return (time_filter(validated, t_from, t_to)
            .groupBy(bucket("1 minute", "time").alias("minute"))
            .agg(F.count(F.lit(1)).alias("events")).orderBy("minute"))


def gaps_per_hour(gap_alerts: DataFrame, t_from, t_to) -> DataFrame:
    """A7."""
    return (time_filter(gap_alerts, t_from, t_to)
            .groupBy(bucket("1 hour", "time").alias("hour"))
            .agg(F.count(F.lit(1)).alias("gaps")).orderBy("hour"))


def late_pct_hourly(late_events: DataFrame, validated: DataFrame, t_from, t_to) -> DataFrame:
    """Per hour, late events / validated readings x 100, NULL without readings.

    Both sides are hourly aggregates (small), joined on the bucket; the readings
    are those of the hours that the range touches.
    """
    hours = (F.date_trunc("hour", _ts(t_from)), F.date_trunc("hour", _ts(t_to)) + F.make_dt_interval(F.lit(0), F.lit(1)))
    validated = validated.where((F.col("time") >= hours[0]) & (F.col("time") < hours[1]))
    if "event_date" in validated.columns:
        validated = validated.where(F.col("event_date").between(F.to_date(hours[0]), F.to_date(hours[1])))
    late = (time_filter(late_events, t_from, t_to)
            .groupBy(bucket("1 hour", "time").alias("hour")).agg(F.count(F.lit(1)).alias("_n")))
    val = validated.groupBy(bucket("1 hour", "time").alias("hour")).agg(F.count(F.lit(1)).alias("_d"))
    pct = F.col("_n").cast("double") / F.nullif(F.col("_d"), F.lit(0)) * F.lit(100.0)
    return late.join(val, "hour", "left").select("hour", pct.alias("late_pct")).orderBy("hour")


def top_gap_meters(gap_alerts: DataFrame, t_from, t_to, k: int = 10) -> DataFrame:
    """The ``k`` meters with most gap alerts (ties by meter id)."""
    return (time_filter(gap_alerts, t_from, t_to).groupBy("meter_id")
            .agg(F.count(F.lit(1)).alias("gap_count"), F.sum("gap_minutes").cast("bigint").alias("total_gap_minutes"))
            .orderBy(F.desc("gap_count"), F.asc("meter_id")).limit(k))


def status_counts(validated: DataFrame, now, hours: int = 1) -> DataFrame:
    """A10 / F5."""
    return since(validated, now, hours).agg(
        F.count_if(F.col("status") == F.lit("OK")).alias("ok_count"),
        F.count_if(F.col("status") == F.lit("LATE")).alias("late_count"))


# -- meter drill-down -----------------------------------------------------

def meter_list(validated: DataFrame) -> DataFrame:
    """O4."""
    return validated.select("meter_id").distinct().orderBy("meter_id")


def consumption_series(validated: DataFrame, t_from, t_to, meter_id: str | None = None) -> DataFrame:
    """O5."""
    return (meter_filter(time_filter(validated, t_from, t_to), meter_id)
            .select("time", "consumption_kwh").orderBy("time"))


def gap_series(gap_alerts: DataFrame, t_from, t_to, meter_id: str | None = None) -> DataFrame:
    """(missing_from, gap_minutes)."""
    return (meter_filter(time_filter(gap_alerts, t_from, t_to), meter_id)
            .select(F.col("missing_from").alias("gap_start"), F.col("gap_minutes").alias("value"))
            .orderBy("gap_start"))


def late_series(late_events: DataFrame, t_from, t_to, meter_id: str | None = None) -> DataFrame:
    """(event_timestamp, delay_seconds)."""
    return (meter_filter(time_filter(late_events, t_from, t_to), meter_id)
            .select(F.col("event_timestamp").alias("event_time"), F.col("delay_seconds").alias("value"))
            .orderBy("event_time"))


def meter_stats(validated: DataFrame, t_from, t_to, meter_id: str | None = None) -> DataFrame:
    """A11."""
    return (meter_filter(time_filter(validated, t_from, t_to), meter_id).groupBy("meter_id")
            .agg(F.count(F.lit(1)).alias("total_readings"),
                 F.count_if(F.col("status") == F.lit("LATE")).alias("late_readings"),
                 F.max("time").alias("last_reading")))


# -- system health ----------------------------------------------------------

def processing_series(metrics: DataFrame, t_from, t_to) -> DataFrame:
    """GROUP BY time, value without aggregate = DISTINCT."""
    return (time_filter(metrics.where(F.col("metric_type") == F.lit("event_processed")), t_from, t_to)
            .select("time", "value").distinct().orderBy("time"))


def _per_minute(metrics: DataFrame, cond: Column, t_from, t_to, name: str) -> DataFrame:
    return (time_filter(metrics.where(cond), t_from, t_to)
            .groupBy(bucket("1 minute", "time").alias("minute"))
            .agg(F.count(F.lit(1)).alias(name)).orderBy("minute"))


def error_rate(metrics: DataFrame, t_from, t_to) -> DataFrame:
    """A13."""
    return _per_minute(metrics, F.col("metric_type").isin("processing_error", "invalid_event"),
                       t_from, t_to, "errors")


def gap_rate(metrics: DataFrame, t_from, t_to) -> DataFrame:
    """``LIKE 'gap_%'`` (``_`` is a one-character wildcard, as in SQL)."""
    return _per_minute(metrics, F.col("metric_type").like("gap_%"), t_from, t_to, "gaps")


def late_rate(metrics: DataFrame, t_from, t_to) -> DataFrame:
    """A15."""
    return _per_minute(metrics, F.col("metric_type") == F.lit("too_late_event"), t_from, t_to, "late_events")


def metric_types(metrics: DataFrame, t_from, t_to) -> DataFrame:
    """A16."""
    return (time_filter(metrics, t_from, t_to).groupBy("metric_type")
            .agg(F.count(F.lit(1)).alias("count"), F.sum("value").alias("total_value"),
                 F.avg("value").alias("avg_value"))
            .orderBy(F.desc("count"), F.asc("metric_type")))


def active_meters(validated: DataFrame, now, hours_back: int = 24) -> DataFrame:
    """A17 (U3): per meter last reading and count since ``now - hours_back``."""
    return (since(validated, now, hours_back).groupBy("meter_id")
            .agg(F.max("time").alias("last_seen"), F.count(F.lit(1)).alias("reading_count"))
            .orderBy(F.desc("last_seen"), F.asc("meter_id")))
