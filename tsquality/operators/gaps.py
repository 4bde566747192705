"""Missing intervals.

Gap rule (W1): with the meter's last reading ``last`` and a new reading ``cur``,
a gap exists iff ``cur - last > tolerance * interval`` (strictly) and
``int((cur - last - interval) / 60 s) > 0``; it reports
``missing_from = last + interval``, ``missing_to = cur`` and that minute count.

Silence rule (W4, SURVEY D3-D5, D7): after a reading at ``t`` the k-th alert
(k = 1, 2, ...) is due at ``t + k*interval + grace`` and reports
``t + k*interval`` to ``t + k*interval + grace`` (grace/60 minutes); it stops
when the meter reports again, at the state TTL (``t + ttl``), or at the end of
event-time progress.

All arithmetic is BIGINT microseconds; no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsquality.config import DEFAULT, QualityConfig
from tsquality.functions.arith import idiv
from tsquality.operators.sequence import ordered_scan

GAP_COLUMNS = ["time", "meter_id", "missing_from", "missing_to", "gap_minutes"]
NEW_COLUMNS = ["time", "missing_from", "missing_to", "gap_minutes"]


def _keep(df: DataFrame, replaced) -> list:
    return [F.col(f"`{c}`") for c in df.columns if c not in replaced]


def gap_condition(cur_us: Column, last_us: Column, cfg: QualityConfig = DEFAULT) -> Column:
    actual = cur_us - last_us
    return ((actual.cast("double") > F.lit(cfg.gap_tolerance * cfg.interval_us))
            & (idiv(actual - F.lit(cfg.interval_us), F.lit(60_000_000)) > F.lit(0)))


def gap_minutes(cur_us: Column, last_us: Column, cfg: QualityConfig = DEFAULT) -> Column:
    return idiv(cur_us - last_us - F.lit(cfg.interval_us), F.lit(60_000_000)).cast("int")


def expected_next(ts: Column, cfg: QualityConfig = DEFAULT) -> Column:
    """``ts + interval``."""
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(cfg.interval_us))


def gap_rows(df: DataFrame, cur_us: str, last_us: str, cfg: QualityConfig = DEFAULT) -> DataFrame:
    """Rows of ``df`` that open a gap, projected to the gap-alert shape (+ carried columns)."""
    cur, last = F.col(cur_us), F.col(last_us)
    missing_from = F.timestamp_micros(last + F.lit(cfg.interval_us))
    return (df.where(last.isNotNull() & gap_condition(cur, last, cfg))
            .select(*_keep(df, NEW_COLUMNS), missing_from.alias("missing_from"), F.timestamp_micros(cur).alias("missing_to"),
                    gap_minutes(cur, last, cfg).alias("gap_minutes"), missing_from.alias("time")))


def gap_events(readings: DataFrame, cfg: QualityConfig = DEFAULT, hot="detect") -> DataFrame:
    """W1 in event-time order: each reading against the meter's previous reading.

    ``readings``: accepted readings with meter_id, timestamp, seq. ``hot``: see
    :func:`~tsquality.operators.sequence.ordered_scan` (``None`` when the caller
    knows no segment can exceed the limit).
    """
    d = readings.select("meter_id", "timestamp", "seq", F.unix_micros("timestamp").alias("_us"))
    d = ordered_scan(d, "meter_id", "_us", ["_us", "seq"], [("_prev_us", "prev", "_us")], cfg, hot=hot)
    return gap_rows(d, "_us", "_prev_us", cfg).select(*GAP_COLUMNS)


def missing_intervals(gaps: DataFrame, cfg: QualityConfig = DEFAULT, stride: int = 1) -> DataFrame:
    """Split each gap into interval slots, the last one clipped at ``missing_to``.

    The slots start at ``last + j*interval`` (j = 1, 2, ...) while before
    ``missing_to``; slots shorter than a minute are dropped. ``stride=2`` keeps
    every second slot (j = 1, 3, 5, ...), the helper as the reference wrote it.
    """
    i = cfg.interval_us
    start = F.unix_micros("missing_from")
    end = F.unix_micros("missing_to")
    slots = F.when(start < end, F.sequence(start, end - F.lit(1), F.lit(i * stride)))
    d = gaps.select("meter_id", F.col("missing_from").alias("gap_from"), "missing_to",
                    F.explode(slots).alias("_s"))
    slot_end = F.least(F.col("_s") + F.lit(i), F.unix_micros("missing_to"))
    minutes = idiv(slot_end - F.col("_s"), F.lit(60_000_000)).cast("int")
    return (d.select("meter_id", "gap_from", F.timestamp_micros("_s").alias("slot_from"),
                     F.timestamp_micros(slot_end).alias("slot_to"), minutes.alias("slot_minutes"))
            .where(F.col("slot_minutes") > 0))


def cascade(armed: DataFrame, t_us: str, limit_us: Column, cfg: QualityConfig = DEFAULT) -> DataFrame:
    """W4 expansion: alerts k = 1.. with due ``t + k*i + g <= min(limit, t + ttl)``.

    The number of steps per reading is at most ``(ttl - grace) / interval``.
    """
    i, g = cfg.interval_us, cfg.grace_us
    t = F.col(t_us)
    cap = F.least(limit_us, t + F.lit(cfg.ttl_us))
    # least() skips NULLs: a NULL limit means "never fires", not "up to the TTL".
    kmax = F.when(limit_us.isNotNull(), idiv(cap - t - F.lit(g), F.lit(i)))
    d = armed.select("*", F.explode(F.when(kmax >= 1, F.sequence(F.lit(1).cast("bigint"), kmax))).alias("_k"))
    missing_from = F.timestamp_micros(t + F.col("_k") * F.lit(i))
    return d.select(*_keep(d, NEW_COLUMNS), missing_from.alias("missing_from"),
                    F.timestamp_micros(t + F.col("_k") * F.lit(i) + F.lit(g)).alias("missing_to"),
                    F.lit(cfg.grace_seconds // 60).cast("int").alias("gap_minutes"), missing_from.alias("time"))


def silence_alerts(readings: DataFrame, cfg: QualityConfig = DEFAULT, final_wm_us: int | None = None,
                   hot="detect") -> DataFrame:
    """W4 in event-time order: cascade after each reading until the next one.

    The end of progress is the largest event time over all meters minus the
    bound (the watermark of a closing batch) unless ``final_wm_us`` is given.
    """
    d = readings.select("meter_id", "timestamp", "seq", F.unix_micros("timestamp").alias("_us"))
    if final_wm_us is None:
        m = d.agg(F.max("_us")).first()[0]
        if m is None:
            return cascade(d.limit(0), "_us", F.lit(0), cfg).select(*GAP_COLUMNS)
        final_wm_us = m - cfg.bound_us
    d = ordered_scan(d, "meter_id", "_us", ["_us", "seq"], [("_next_us", "next", "_us")], cfg, hot=hot)
    limit = F.least(F.coalesce(F.col("_next_us") - F.lit(1), F.lit(final_wm_us)), F.lit(final_wm_us))
    return cascade(d, "_us", limit, cfg).select(*GAP_COLUMNS)
