"""Event-time progress and lateness.

The stream's watermark is the largest valid event time of all *earlier*
micro-batches minus the bound (Spark keeps it in milliseconds). In batch form a
micro-batch is an arrival bucket: rows whose ``arrival_ts`` falls in the same
``bucket_seconds`` window. ``arrival_batches`` builds the per-bucket table once:

  bucket -> watermark (of that batch), pred_watermark (of the batch before)

It is an aggregate of the rows (map-side combined) followed by a running max
over buckets, taken inside blocks of buckets and carried over a table of blocks.
Its size is the number of arrival buckets (time span / bucket width), not the
number of rows; Spark broadcasts it or not by its size in bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsquality.config import DEFAULT, QualityConfig
from tsquality.functions.arith import idiv

ON_TIME, LATE, TOO_LATE = "ON_TIME", "LATE", "TOO_LATE"
BUCKET = "_bucket"
BLOCK = 4096  # buckets of a block


def bucket_of(bucket_seconds: int, arrival: str = "arrival_ts") -> Column:
    """The arrival micro-batch number."""
    return idiv(F.unix_micros(arrival), F.lit(bucket_seconds * 1_000_000))


def with_bucket(df: DataFrame, bucket_seconds: int, arrival: str = "arrival_ts") -> DataFrame:
    """Add ``_bucket``: the arrival micro-batch number."""
    return df.withColumn(BUCKET, bucket_of(bucket_seconds, arrival))


def arrival_batches(rows: DataFrame, cfg: QualityConfig = DEFAULT, valid: str = "error") -> DataFrame:
    """Per arrival bucket: ``wm_us`` and ``pred_wm_us`` (NULL before any valid row).

    ``rows`` holds every input row with ``_bucket``; rows whose ``valid`` column is
    non-NULL (invalid rows) form batches too but do not move the watermark.
    """
    ev_ms = F.when(F.col(valid).isNull(), idiv(F.unix_micros("timestamp"), F.lit(1000)))
    per = rows.groupBy(BUCKET).agg(F.max(ev_ms).alias("_max_ms"),
                                   F.count(F.lit(1)).alias("_n_rows"),
                                   F.count_if(F.col(valid).isNull()).alias("_n_valid"))
    per = per.withColumn("_block", idiv(F.col(BUCKET), F.lit(BLOCK)))
    w = Window.partitionBy("_block").orderBy(BUCKET)
    x = per.select("*", F.max("_max_ms").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                   F.lag(BUCKET).over(w).isNull().alias("_first"), F.lead(BUCKET).over(w).isNull().alias("_last"))
    x = x.select("*", F.lag("_before").over(w).alias("_prev_before"))
    # A row a block: what earlier blocks give to all of a block's buckets, and to its first one's predecessor.
    wb = Window.orderBy("_block")
    blocks = x.groupBy("_block").agg(F.max("_max_ms").alias("_all"), F.max(F.when(F.col("_last"), F.col("_before"))).alias("_rest"))
    blocks = blocks.select("_block", "_rest", F.max("_all").over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    blocks = blocks.select("_block", "_carry", F.greatest(F.lag("_carry").over(wb), F.lag("_rest").over(wb)).alias("_pred"))

    def us(ms: Column) -> Column:
        return ms * F.lit(1000) - F.lit(cfg.bound_us)
    pred = F.when(F.col("_first"), F.col("_pred")).otherwise(F.greatest("_prev_before", "_carry"))
    return x.join(blocks, "_block").select(BUCKET, "_max_ms", "_n_rows", "_n_valid",
                                           us(F.greatest("_before", "_carry")).alias("wm_us"), us(pred).alias("pred_wm_us"))


def batch_summary(batches: DataFrame, cfg: QualityConfig = DEFAULT) -> dict:
    """One small job over the per-bucket table: closing watermark, bucket and row counts."""
    r = batches.agg(F.max("_max_ms"), F.count(F.lit(1)), F.sum("_n_valid")).first()
    return {"final_wm_us": None if r[0] is None else r[0] * 1000 - cfg.bound_us,
            "buckets": r[1], "valid_rows": r[2] or 0}


def classify_event(ts_us: Column, wm_us: Column, cfg: QualityConfig = DEFAULT) -> Column:
    """NULL watermark or delay <= 0 -> ON_TIME; delay <= allowed lateness -> LATE; else TOO_LATE."""
    delay = wm_us - ts_us
    return (F.when(wm_us.isNull() | (delay <= F.lit(0)), F.lit(ON_TIME))
            .when(delay <= F.lit(cfg.lateness_us), F.lit(LATE))
            .otherwise(F.lit(TOO_LATE)))


def calculate_delay(ts_us: Column, wm_us: Column) -> Column:
    """T4: whole seconds behind the watermark, truncated; NULL when not behind."""
    delay = wm_us - ts_us
    return F.when(delay > F.lit(0), idiv(delay, F.lit(1_000_000)).cast("int"))


def classify(rows: DataFrame, cfg: QualityConfig = DEFAULT) -> DataFrame:
    """Add ``timing`` and ``delay_seconds`` from ``timestamp`` and ``wm_us``."""
    ts_us = F.unix_micros("timestamp")
    return rows.select("*", classify_event(ts_us, F.col("wm_us"), cfg).alias("timing"),
                       calculate_delay(ts_us, F.col("wm_us")).alias("delay_seconds"))
