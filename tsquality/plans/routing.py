"""The whole per-reading flow as one batch plan (the stream's twin).

Input rows carry ``meter_id, timestamp, consumption_kwh, seq, arrival_ts``
(optionally ``parse_error`` for payloads that were not JSON). A micro-batch is
an arrival bucket of ``bucket_seconds``. The plan reproduces, row for row, what
the stateful stream (``streaming.processor``) emits when fed one bucket per
trigger:

* invalid rows -> ``invalid_event`` metrics; unparsable -> ``processing_error``;
* valid rows are classified against the batch watermark (J2, T3);
  TOO_LATE -> late_events + ``too_late_event``;
* accepted rows (ON_TIME, LATE) -> validated (status OK / LATE) + ``event_processed``;
* a resume gap against the meter's last reading (running max over earlier
  arrivals, SURVEY D6) -> gap alert ``event`` + ``gap_detected``; not after the
  meter's state expired (TTL);
* silence timers: after a reading that advances the meter's last reading, the
  cascade fires in every batch before the meter's next advancing reading
  (rows before timers in a batch), up to the watermark of the batch before that
  reading, or the closing no-data batch, and never past the TTL ->
  gap alert ``timer`` + ``gap_detected_timer``.

Everything is joins, aggregates and windows partitioned by meter (skew-safe,
``operators.sequence``); the only small tables are per arrival bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsquality.config import DEFAULT, QualityConfig
from tsquality.operators import lateness as L
from tsquality.operators.gaps import cascade, gap_rows
from tsquality.operators.sequence import detect_hot, ordered_scan
from tsquality.operators.validate import validate
from tsquality.session import materialize

ORDER = ["_bucket", "_us", "seq"]


@dataclass
class Routes:
    rows: DataFrame         # every input row, validated, with _bucket
    batches: DataFrame      # per arrival bucket: wm_us, pred_wm_us
    classified: DataFrame   # valid rows with wm_us, timing, delay_seconds
    validated: DataFrame
    late_events: DataFrame
    gap_alerts: DataFrame
    metrics: DataFrame
    meter_state: DataFrame
    final_wm_us: int | None


VALIDATED_COLS = ["time", "meter_id", "consumption_kwh", "status"]
LATE_COLS = ["time", "meter_id", "event_timestamp", "consumption_kwh", "delay_seconds"]
ALERT_COLS = ["time", "meter_id", "missing_from", "missing_to", "gap_minutes", "detected_by"]
METRIC_COLS = ["time", "metric_type", "meter_id", "value", "tags"]
SEQ_COLS = ["_bucket", "seq"]


def route(raw: DataFrame, cfg: QualityConfig = DEFAULT, bucket_seconds: int = 60,
          out_path: str | None = None, closing: bool = True) -> Routes:
    """Build the routed run. Without ``closing`` there is no batch without rows at the end: timers fire up to the
    watermark of the last bucket, and a stream can go on from ``meter_state`` (``streaming.job.handed_over``). With ``out_path`` the routed outputs are written there
    (staging parquet) and the returned frames read them back.

    Reuse without extra copies: the validated table is written with a few
    internal columns (``_prev_max``, ``_expired``, ...) and read back for the
    later steps (alerts, metrics, state); nothing the size of the input is
    written twice. Without ``out_path``, ``cfg.materialize`` decides.
    """
    has_parse = "parse_error" in raw.columns
    rows = raw if "validation" in raw.columns else validate(raw, cfg)
    if has_parse:
        rows = rows.withColumn("error", F.when(F.col("parse_error").isNull(), F.col("error"))
                               .otherwise(F.lit("processing_error")))
    rows = rows.select("*", L.bucket_of(bucket_seconds).alias(L.BUCKET), F.unix_micros("timestamp").alias("_us"))

    # Per arrival bucket: watermark of the batch and of the batch before (a row a bucket).
    batches = materialize(L.arrival_batches(rows, cfg), cfg.materialize)
    summary = L.batch_summary(batches, cfg)
    final_wm = summary["final_wm_us"] if closing else batches.agg(F.max_by("wm_us", L.BUCKET)).first()[0]
    wm_small = batches.select(L.BUCKET, "wm_us", "pred_wm_us")

    valid = rows.where(F.col("error").isNull())
    classified = L.classify(valid.join(wm_small, on=L.BUCKET, how="left"), cfg)
    too_late = classified.where(F.col("timing") == F.lit(L.TOO_LATE))
    accepted = classified.where(F.col("timing") != F.lit(L.TOO_LATE))

    seg = max(1, cfg.segment_seconds // bucket_seconds)
    # No segment can exceed the limit when all valid rows together do not.
    hot = (detect_hot(accepted, "meter_id", cfg, pos="_bucket", segment_us=seg)
           if summary["valid_rows"] > cfg.max_segment_rows else None)
    acc = ordered_scan(accepted, "meter_id", "_bucket", ORDER, [("_prev_max", "prev_max", "_us")], cfg,
                       segment_us=seg, hot=hot)
    expired = F.col("_prev_max").isNotNull() & (F.col("_prev_max") + F.lit(cfg.ttl_us) <= F.col("pred_wm_us"))
    acc = acc.select(F.col("timestamp").alias("time"), "meter_id", "consumption_kwh",
                     F.when(F.col("timing") == F.lit(L.LATE), F.lit("LATE")).otherwise(F.lit("OK")).alias("status"),
                     "arrival_ts", "_us", *SEQ_COLS, "_prev_max",
                     F.coalesce(expired, F.lit(False)).alias("_expired"))
    late_events = too_late.select(F.col("timestamp").alias("time"), "meter_id",
                                  F.col("timestamp").alias("event_timestamp"), "consumption_kwh",
                                  F.coalesce("delay_seconds", F.lit(0)).alias("delay_seconds"),
                                  "arrival_ts", "_us", *SEQ_COLS)
    if out_path:
        acc = _save(acc, out_path, "validated_readings")
        late_events = _save(late_events, out_path, "late_events")
    else:
        acc = materialize(acc, cfg.materialize)
    validated = acc

    live_prev = F.when(~F.col("_expired"), F.col("_prev_max"))
    resume = gap_rows(acc.select("*", live_prev.alias("_live_prev")), "_us", "_live_prev", cfg) \
        .select("*", F.lit("event").alias("detected_by"))

    arming = acc.where(F.col("_prev_max").isNull() | (F.col("_us") > F.col("_prev_max")))
    arming = ordered_scan(arming.select("meter_id", "_bucket", "_us", "seq"), "meter_id", "_bucket", ORDER,
                          [("_next_bucket", "next", "_bucket")], cfg, segment_us=seg, hot=hot)
    pred = wm_small.select(F.col(L.BUCKET).alias("_next_bucket"), F.col("pred_wm_us").alias("_next_pred_wm"))
    arming = arming.join(pred, on="_next_bucket", how="left")
    no_end = F.lit(final_wm) if final_wm is not None else F.lit(None).cast("bigint")
    limit = (F.when(F.col("_next_bucket").isNull(), no_end)
             .when(F.col("_next_bucket") == F.col("_bucket"), F.lit(None).cast("bigint"))
             .otherwise(F.col("_next_pred_wm")))
    timers = cascade(arming, "_us", limit, cfg).select("*", F.lit("timer").alias("detected_by"))

    alerts = (timers.select(*ALERT_COLS, F.col("missing_to").alias("arrival_ts"), "_us", "_bucket", "seq", "_k")
              .unionByName(resume.select(*ALERT_COLS, "arrival_ts", "_us", "_bucket", "seq",
                                         F.lit(0).cast("bigint").alias("_k"))))
    if out_path:
        alerts = _save(alerts, out_path, "gap_alerts")

    metrics = _metrics(rows, late_events, validated, alerts, has_parse)
    state = _meter_state(acc, late_events, alerts, final_wm, cfg)
    if out_path:
        metrics = _save(metrics, out_path, "metrics")
        state = _save(state, out_path, "meter_state", by_date=False)
    return Routes(rows, batches, classified, validated, late_events, alerts, metrics, state, final_wm)


def _save(df: DataFrame, base: str, name: str, by_date: bool = True) -> DataFrame:
    """Write one routed output (staging, plain parquet) and read it back with its
    known schema (no footer scan). The report tables are the compacted,
    day-partitioned copies made from these (``tables.write_compacted``)."""
    path = f"{base}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _metric(df: DataFrame, kind: str, value, tags, time="arrival_ts", meter="meter_id") -> DataFrame:
    return df.select(F.col(time).alias("time"), F.lit(kind).alias("metric_type"),
                     (F.col(meter) if isinstance(meter, str) else meter).alias("meter_id"),
                     value.cast("double").alias("value"), tags.alias("tags"), *SEQ_COLS)


def _no_tags():
    return F.create_map().cast("map<string,string>")


def _metrics(rows, late_events, validated, alerts, has_parse) -> DataFrame:
    """One metric row per occurrence, derived from the routed rows (time = arrival
    time; for timer alerts the due time; the stream stamps processing time)."""
    invalid = rows.where(F.col("error").isNotNull() & (F.col("error") != F.lit("processing_error")))
    resume = alerts.where(F.col("detected_by") == F.lit("event"))
    timers = alerts.where(F.col("detected_by") == F.lit("timer"))
    parts = [
        _metric(invalid, "invalid_event", F.lit(1.0), F.create_map(F.lit("error"), F.col("error"))),
        _metric(late_events, "too_late_event", F.lit(1.0), _no_tags()),
        _metric(resume, "gap_detected", F.col("gap_minutes"), _no_tags()),
        _metric(validated, "event_processed", F.lit(1.0), F.create_map(F.lit("status"), F.col("status"))),
        _metric(timers, "gap_detected_timer", F.col("gap_minutes"), _no_tags()),
    ]
    if has_parse:
        bad = rows.where(F.col("error") == F.lit("processing_error"))
        parts.append(_metric(bad, "processing_error", F.lit(1.0),
                             F.create_map(F.lit("error"), F.col("parse_error")), meter=F.lit("unknown")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _meter_state(acc, late_events, alerts, final_wm, cfg: QualityConfig) -> DataFrame:
    """T6 final state: meters whose state is alive after the closing batch.

    Counters cover the state's current life, which starts at the meter's last
    accepted reading that found no live state (first reading, or after TTL expiry).
    """
    order = F.struct("_bucket", "_us", "seq")
    restart = F.col("_prev_max").isNull() | F.col("_expired")
    per = (acc.groupBy("meter_id")
           .agg(F.max("_us").alias("_last"), F.max(F.when(restart, order)).alias("_r0")))
    alive = F.lit(True) if final_wm is None else (F.col("_last") + F.lit(cfg.ttl_us) > F.lit(final_wm))
    per = materialize(per.where(alive).select("meter_id", "_last", "_r0"), cfg.materialize)

    def count_after(df, name, inclusive):
        j = df.select("meter_id", order.alias("_o")).join(per.select("meter_id", "_r0"), "meter_id")
        cond = (F.col("_o") >= F.col("_r0")) if inclusive else (F.col("_o") > F.col("_r0"))
        return j.where(cond).groupBy("meter_id").agg(F.count(F.lit(1)).alias(name))

    gaps = count_after(alerts, "_gaps", True)
    lates = count_after(late_events, "_lates", False)
    return (per.join(gaps, "meter_id", "left").join(lates, "meter_id", "left")
            .select("meter_id",
                    F.timestamp_micros("_last").alias("last_seen"),
                    F.timestamp_micros(F.col("_last") + F.lit(cfg.interval_us)).alias("expected_next"),
                    F.lit(cfg.interval_minutes).alias("interval_minutes"),
                    F.coalesce("_gaps", F.lit(0)).cast("bigint").alias("gap_count"),
                    F.coalesce("_lates", F.lit(0)).cast("bigint").alias("late_count")))
