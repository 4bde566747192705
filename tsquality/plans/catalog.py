"""Registered queries over the driver tables (one per operator of SURVEY section 2).

Every query reads the whole ``events`` table (through the reading adapter) and
derives what it needs from it with Spark. Parameters are fixed here:

* ``events`` users report about every 7 hours, not every 30 minutes, so the
  reading interval is 480 minutes (SURVEY 5.1);
* faults (G2) are injected with seed 42: 5 % of readings dropped, 10 % delayed
  by up to 3 hours, 1 % made invalid (negative or too large), 2 % sent again,
  and 2 % of the payloads spoiled (fields missing, empty or unreadable, no JSON);
* a micro-batch is one arrival hour; reports use the range
  2024-01-01 .. 2024-01-31 and ``now`` = 2024-01-31 00:00.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsquality.config import QualityConfig
from tsquality.operators import gaps as G
from tsquality.operators import rollups as R
from tsquality.operators import tables as T
from tsquality.operators.validate import quarantine_metrics, validate
from tsquality.plans import reports as Q
from tsquality.plans import sql as SQL
from tsquality.plans.routing import route
from tsquality.session import materialize, scratch_path
from tsquality.sources.events import load_readings
from tsquality.functions.hashing import uniform01, with_uniforms
from tsquality.sources import csv as CSV
from tsquality.sources.messages import parse_readings
from tsquality.sources.replay import write_after, write_replay
from tsquality.sources.synth import faulty_messages, inject_faults, sample_like
from tsquality.streaming import job
from tsquality.streaming.counts import counted, observe_errors

CFG = QualityConfig(interval_minutes=480)
FAULTS = dict(seed=42, gap_probability=0.05, delay_probability=0.1, max_delay_seconds=10800,
              corrupt_probability=0.01, repeat_probability=0.02)
PAYLOAD_FAULTS = dict(seed=42, probability=0.02)
BUCKET_SECONDS = 3600
NOW = dt.datetime(2024, 1, 31)
T_FROM = dt.datetime(2024, 1, 1)
T_TO = NOW

_lock = threading.RLock()
_routes: dict = {}


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_readings(spark, sf_dir)


_faulted: dict = {}


def faulted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replayed input (G2): written once per session like a filled topic, then read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _faulted:
            _faulted[key] = materialize(inject_faults(readings(spark, sf_dir), **FAULTS), "checkpoint")
        return _faulted[key]


_parsed: dict = {}


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw topic's messages, parsed and validated (P1, P3); written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _parsed:
            p = parse_readings(faulty_messages(faulted(spark, sf_dir), **PAYLOAD_FAULTS), CFG)
            _parsed[key] = materialize(p.drop("key", "value", "topic"), "checkpoint")
        return _parsed[key]


def routes(spark: SparkSession, sf_dir: str):
    """The routed run, built once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _routes:
            out = scratch_path(spark, "routed")
            _routes[key] = route(parsed(spark, sf_dir), CFG, BUCKET_SECONDS, out_path=out)
        return _routes[key]


_clean: dict = {}


def _accepted_clean(spark, sf_dir):
    """Valid readings of the events, written once per session; with the row count
    (from the file footers) that tells whether any time segment can be hot."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _clean:
            df = materialize(validate(readings(spark, sf_dir), CFG).where(F.col("error").isNull())
                             .select("meter_id", "timestamp", "consumption_kwh", "seq"), "checkpoint")
            n = df.count()
            _clean[key] = (df, None if n <= CFG.max_segment_rows else "detect", {})
        return _clean[key][0]


def _hot(spark, sf_dir):
    _accepted_clean(spark, sf_dir)
    return _clean[(spark.sparkContext.applicationId, sf_dir)][1]


def _gaps(spark, sf_dir):
    """W1 over the clean readings, written once per session (used by three queries)."""
    _accepted_clean(spark, sf_dir)
    memo = _clean[(spark.sparkContext.applicationId, sf_dir)][2]
    with _lock:
        if "gaps" not in memo:
            memo["gaps"] = materialize(G.gap_events(_accepted_clean(spark, sf_dir), CFG, hot=_hot(spark, sf_dir)),
                                       "checkpoint")
        return memo["gaps"]


_tables: dict = {}


def tables(spark, sf_dir):
    """The four tables as the reports read them: key rules applied once and
    compacted (S12) into the shared folder, partitioned by day."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _tables:
            r = routes(spark, sf_dir)
            base = scratch_path(spark, "tables")
            _tables[key] = dict(
                validated=T.write_compacted(T.resolve_routed(r.validated, "validated_readings"),
                                            base + "/validated_readings"),
                gap_alerts=T.write_compacted(T.resolve_routed(r.gap_alerts, "gap_alerts"), base + "/gap_alerts"),
                late_events=T.write_compacted(T.resolve_routed(r.late_events, "late_events"), base + "/late_events"),
                metrics=T.write_compacted(r.metrics, base + "/metrics"),
            )
        return _tables[key]


#: Rows of a file that one task writes where an example fills a topic.
ROWS_PER_FILE = 500_000


def files_for(rows: int) -> int:
    return 1 + rows // ROWS_PER_FILE


# -- ingest / validate -------------------------------------------------------

def aliased_text_rows(readings: DataFrame, seed: int = 42) -> DataFrame:
    """Readings rendered as the aliased text rows of assorted CSV exports: the id
    and time go to one of their alias columns (the others stay empty) and the
    time is written in one of three forms."""
    readings = with_uniforms(readings, seed, {"_u_id": ("alias_id", "seq"), "_u_ts": ("alias_ts", "seq"),
                                              "_u_fmt": ("ts_format", "seq")})
    u_id, u_ts, u_fmt = F.col("_u_id"), F.col("_u_ts"), F.col("_u_fmt")
    ts = F.col("timestamp")
    text = (F.when(u_fmt < 1 / 3, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(u_fmt < 2 / 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")))

    def slot(u, i, v):
        return F.when((u >= i / 3) & (u < (i + 1) / 3), v).otherwise(F.lit(""))
    cols = [F.col("seq").cast("string").alias("seq")]
    cols += [slot(u_id, i, F.col("meter_id")).alias(n) for i, n in enumerate(CSV.METER_ALIASES)]
    cols += [slot(u_ts, i, text).alias(n) for i, n in enumerate(CSV.TIME_ALIASES)]
    cols += [F.col("consumption_kwh").cast("string").alias("kwh")]
    return readings.select(*cols)


# The columns of the three kinds of export; an alias that an export lacks is filled from the others.
CSV_EXPORTS = (("seq", *CSV.METER_ALIASES, *CSV.TIME_ALIASES, "kwh"), ("seq", "id", "time", "consumption"),
               ("consumption_kwh", "datetime", "meterId", "seq"))


def csv_exports(spark, sf_dir, path: str) -> None:
    """Three folders of CSV files with headers of their own; in some rows the time or the value
    cannot be read."""
    rows = aliased_text_rows(readings(spark, sf_dir)).withColumns(
        {"_n": F.col("seq").cast("bigint"), "_bad": uniform01(42, "csv_bad", "seq")})
    mid, ts = CSV.first_present(rows, CSV.METER_ALIASES), CSV.first_present(rows, CSV.TIME_ALIASES)
    time = F.when(F.col("_bad") < 0.01, F.lit('no "time", none')).otherwise(ts)
    kwh = F.when(F.col("_bad") >= 0.99, F.lit("n/a")).otherwise(F.col("kwh"))
    for k, header in enumerate(CSV_EXPORTS):
        part = rows.where(F.col("_n") % len(CSV_EXPORTS) == k)
        if k == 0:  # the aliased columns as they are; a bad time stands in the first of them
            bad = F.col("_bad") < 0.01
            part = part.withColumns({c: F.when(bad, time if c == CSV.TIME_ALIASES[0] else F.lit("")).otherwise(F.col(c))
                                     for c in CSV.TIME_ALIASES} | {"kwh": kwh})
        else:
            values = {"seq": F.col("seq"), "id": mid, "meterId": mid, "time": time, "datetime": time, "consumption": kwh,
                      "consumption_kwh": kwh}
            part = part.select(*(values[c].alias(c) for c in header))
        part.select(*header).write.option("header", True).option("escape", '"').csv(f"{path}/export={k}")


def q_csv_alias_parse(spark, sf_dir):
    """S1 + S2: CSV exports with three headers, some rows unreadable, written and read back as
    text, then parsed."""
    path = scratch_path(spark, "csv")
    csv_exports(spark, sf_dir, path)
    parsed = CSV.parse_csv_rows(CSV.read_csv(spark, path, multi_line=False), keep=("seq",))
    return parsed.select(F.col("seq").cast("bigint").alias("seq"), "meter_id", "timestamp", "consumption_kwh")


def q_csv_alias_streamed(spark, sf_dir):
    """S1 + S2 as a stream: files of three headers in one stream, some files a micro-batch."""
    base = scratch_path(spark, "csv-stream")
    csv_exports(spark, sf_dir, f"{base}/in")
    rows = CSV.stream_csv(spark, f"{base}/in", (*CSV.STREAM_COLUMNS, "seq"), files_per_trigger=csv_files(spark))
    parsed = CSV.parse_csv_rows(rows, keep=("seq",)).select(F.col("seq").cast("bigint").alias("seq"), "meter_id", "timestamp",
                                                            "consumption_kwh")
    parsed.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True) \
        .start(f"{base}/out", format="parquet").awaitTermination()
    return spark.read.schema(parsed.schema).parquet(f"{base}/out")


#: CSV files of a micro-batch, at least; a file is read by one task, so there is one for each core.
CSV_FILES = 8


def csv_files(spark) -> int:
    return max(CSV_FILES, spark.sparkContext.defaultParallelism)


def q_stream_batch_counts(spark, sf_dir):
    """S2 + P4 in streams: what a listener wrote of each micro-batch into the metrics table. Messages come in three
    parts, a micro-batch each; CSV exports in as many as their files need, so theirs are summed (batch -1)."""
    base = scratch_path(spark, "counts")
    csv_exports(spark, sf_dir, f"{base}/csv")
    rows = CSV.parse_csv_rows(CSV.stream_csv(spark, f"{base}/csv", files_per_trigger=csv_files(spark)), observation="csv")
    messages = faulty_messages(faulted(spark, sf_dir), **PAYLOAD_FAULTS).withColumnRenamed("seq", "offset")
    messages = materialize(messages.select("key", "value", "offset", "arrival_ts"))

    def count(name, stream):
        counts = counted(spark, f"{base}/{name}-out")
        stream.writeStream.queryName(counts.query_name).option("checkpointLocation", f"{base}/{name}-checkpoint") \
            .trigger(availableNow=True).format("noop").start().awaitTermination()
        counts.wait()

    count("csv", rows)
    files = files_for(messages.count() // COUNTED_BATCHES)
    for k in range(COUNTED_BATCHES):  # the stream goes on after each part, whose files are one micro-batch
        part = messages.where(F.col("offset") % COUNTED_BATCHES == k)
        part.coalesce(files).write.parquet(f"{base}/messages/chunk={k}")
        count("messages", observe_errors(job.message_readings(spark, f"{base}/messages", "parquet", cfg=CFG)))
    found = [T.read_table(spark, f"{base}/{name}-out/metrics", "metrics").select(
        "metric_type", (F.lit(-1) if name == "csv" else F.element_at("tags", "batch")).cast("bigint").alias("batch"), "value")
        for name in ("csv", "messages")]
    return found[0].unionAll(found[1]).groupBy("metric_type", "batch").agg(F.sum("value").alias("value"))


#: Micro-batches of the messages that are counted.
COUNTED_BATCHES = 3


def q_format_convert(spark, sf_dir):
    """S3: third-party rows (id, space-separated time, value; some without id) to standard rows."""
    r = readings(spark, sf_dir)
    r = with_uniforms(r, 42, {"_u": ("no_id", "seq")})
    u = F.col("_u")
    third = r.select("seq", F.when(u < 0.1, F.lit("")).otherwise(F.col("meter_id")).alias("id"),
                     F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"),
                     F.col("consumption_kwh").cast("string").alias("value"))
    return CSV.convert_to_standard(third, keep=("seq",))


def q_json_parse(spark, sf_dir):
    """S5 payloads of the faulted readings, some spoiled, parsed back (P1) and validated."""
    p = parsed(spark, sf_dir)
    return p.select("seq", "meter_id", "timestamp", "consumption_kwh", "validation", "error", "parse_error")


def q_synth_readings(spark, sf_dir):
    """G1 shaped by the events: a regular 30-minute series per meter over its days."""
    return sample_like(readings(spark, sf_dir), interval_minutes=30, seed=42)


def q_validate(spark, sf_dir):
    """P3 on typed rows, where a null is a missing field."""
    typed = parsed(spark, sf_dir).select("seq", "meter_id", "timestamp", "consumption_kwh")
    return validate(typed, CFG).select("seq", "meter_id", "timestamp", "consumption_kwh", "validation")


def q_quarantine_metrics(spark, sf_dir):
    m = quarantine_metrics(parsed(spark, sf_dir))
    return m.select("seq", "metric_type", "meter_id", "value", F.to_json("tags").alias("tags"))


def q_inject_faults(spark, sf_dir):
    return faulted(spark, sf_dir).select("seq", "meter_id", "timestamp", "consumption_kwh", "arrival_ts")


# -- lateness ----------------------------------------------------------------

def q_batch_watermark(spark, sf_dir):
    b = routes(spark, sf_dir).batches
    return b.select(F.timestamp_seconds(F.col("_bucket") * F.lit(BUCKET_SECONDS)).alias("arrival_bucket"),
                    F.timestamp_micros("wm_us").alias("watermark"))


def q_classify_lateness(spark, sf_dir):
    c = routes(spark, sf_dir).classified
    return c.select("seq", "meter_id", "timestamp", "arrival_ts", F.timestamp_micros("wm_us").alias("watermark"),
                    "timing", "delay_seconds")


def q_late_events(spark, sf_dir):
    return routes(spark, sf_dir).late_events.select(*T.COLUMNS["late_events"])


def q_validated_readings(spark, sf_dir):
    return routes(spark, sf_dir).validated.select(*T.COLUMNS["validated_readings"])



# -- gaps --------------------------------------------------------------------

def q_gap_events(spark, sf_dir):
    return _gaps(spark, sf_dir).select(*G.GAP_COLUMNS)


def q_expected_next(spark, sf_dir):
    a = _accepted_clean(spark, sf_dir)
    return a.select("seq", "meter_id", "timestamp", G.expected_next(F.col("timestamp"), CFG).alias("expected_next"))


def q_missing_intervals(spark, sf_dir):
    return G.missing_intervals(_gaps(spark, sf_dir), CFG)


def q_missing_intervals_as_written(spark, sf_dir):
    """W3 with stride 2: every second slot, as the reference's helper computes it."""
    return G.missing_intervals(_gaps(spark, sf_dir), CFG, stride=2)


def q_silence_alerts(spark, sf_dir):
    return G.silence_alerts(_accepted_clean(spark, sf_dir), CFG, hot=_hot(spark, sf_dir))


def q_resume_alerts(spark, sf_dir):
    a = routes(spark, sf_dir).gap_alerts
    return a.where(F.col("detected_by") == "event").select(*G.GAP_COLUMNS)


def q_timer_alerts(spark, sf_dir):
    a = routes(spark, sf_dir).gap_alerts
    return a.where(F.col("detected_by") == "timer").select(*G.GAP_COLUMNS)


def q_meter_state(spark, sf_dir):
    return routes(spark, sf_dir).meter_state


def q_metrics_stream(spark, sf_dir):
    m = routes(spark, sf_dir).metrics
    return m.select("metric_type", "meter_id", "value", F.to_json("tags").alias("tags"), "seq")


# -- tables ------------------------------------------------------------------

def q_validated_table(spark, sf_dir):
    return tables(spark, sf_dir)["validated"].select(*T.COLUMNS["validated_readings"], "arrival_ts")


def q_gap_alerts_table(spark, sf_dir):
    return tables(spark, sf_dir)["gap_alerts"].select(*T.COLUMNS["gap_alerts"], "detected_by")


def q_late_events_table(spark, sf_dir):
    return tables(spark, sf_dir)["late_events"].select(*T.COLUMNS["late_events"], "arrival_ts")


# -- rollups -----------------------------------------------------------------

def q_gap_summary_hourly(spark, sf_dir):
    return R.gap_summary_hourly(tables(spark, sf_dir)["gap_alerts"])


def q_late_summary_hourly(spark, sf_dir):
    return R.late_events_summary_hourly(tables(spark, sf_dir)["late_events"])


def q_metrics_summary_hourly(spark, sf_dir):
    return R.metrics_summary_hourly(tables(spark, sf_dir)["metrics"])


#: The hours at which the refresh runs in ``rollup_refresh``: two windows that share an hour.
REFRESH_AT = (dt.datetime(2024, 1, 15, 12, 30), dt.datetime(2024, 1, 15, 13, 30))


def q_rollup_refresh(spark, sf_dir):
    """A4: the refresh itself, at two moments, each over the events that had arrived by then."""
    late, path = tables(spark, sf_dir)["late_events"], scratch_path(spark, "rollup")
    for now in REFRESH_AT:
        R.refresh(late.where(F.col("arrival_ts") < F.lit(now).cast("timestamp")), "late_events_summary_hourly", path, now)
    schema = "hour TIMESTAMP, meter_id STRING, late_count BIGINT, avg_delay_seconds DOUBLE, max_delay_seconds INT"
    return spark.read.schema(schema).parquet(path).drop("bucket_hour")


def q_rollup_streamed(spark, sf_dir):
    """A4 as a stream: the late events, replayed in the order of their arrival in some chunks, kept up to date hour by hour."""
    base = scratch_path(spark, "rollup-stream")
    late = T.resolve_routed(routes(spark, sf_dir).late_events, "late_events")
    lo, hi = late.agg(F.min(F.unix_micros("arrival_ts")), F.max(F.unix_micros("arrival_ts"))).first()
    part = F.floor((F.unix_micros("arrival_ts") - F.lit(lo or 0)) * ROLLUP_CHUNKS / F.lit((hi or 0) - (lo or 0) + 1)).cast("int")
    late = materialize(late.select("time", "meter_id", "delay_seconds", "arrival_ts", part.alias("chunk")))
    newest = 0
    for k in range(ROLLUP_CHUNKS):
        newest = write_after(late.where(F.col("chunk") == k).drop("chunk").coalesce(1), f"{base}/rows/chunk={k:03d}", newest)
    rows = spark.readStream.schema("time TIMESTAMP, meter_id STRING, delay_seconds INT, arrival_ts TIMESTAMP, chunk INT") \
        .option("maxFilesPerTrigger", 1).parquet(f"{base}/rows")
    R.stream_rollup(rows, "late_events_summary_hourly", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return R.read_stream_rollup(spark, f"{base}/out", "late_events_summary_hourly")


#: Chunks in which the late events arrive at the streamed rollup.
ROLLUP_CHUNKS = 6


def q_rollup_refreshed(spark, sf_dir):
    """A4 over the whole history in closed form: what hourly refreshes leave."""
    late = T.resolve_routed(routes(spark, sf_dir).late_events, "late_events")
    return R.as_refreshed(late, "late_events_summary_hourly")


def q_tables_incremental(spark, sf_dir):
    """S8 + S12: two runs write the readings' log (batches by week, each counted from 0), and each
    write is followed by an incremental compaction; the last one touches the days of the second run alone."""
    base = scratch_path(spark, "log")
    week = F.floor(F.col("_bucket") / (7 * 86400 // BUCKET_SECONDS))
    rows = routes(spark, sf_dir).validated.withColumn("_week", week)
    first = rows.agg(F.min("_week")).first()[0] or 0
    for run, part in (("first", F.col("_week") <= first + 1), ("second", F.col("_week") > first + 1)):
        T.write_batch(rows.where(part), f"{base}/validated_readings", "validated_readings", 0, run)
        out = T.compact(spark, f"{base}/validated_readings", "validated_readings", f"{base}/compacted")
    return out.select(*T.COLUMNS["validated_readings"], "arrival_ts")


# -- the stream --------------------------------------------------------------

#: Messages of a micro-batch of the streamed run, at least. Its arrival buckets are those of the routed run, many a
#: micro-batch; as each micro-batch visits the meters and writes the four tables' days anew, many messages make
#: larger micro-batches, up to the replay's own size, and not more of them.
STREAM_ROWS = 5_000
STREAM_BATCHES = 4
STREAM_ROWS_MOST = 5_000_000
_streams: dict = {}


def stream_rows(messages: int) -> int:
    """Messages of a micro-batch of a streamed run over ``messages``."""
    return max(STREAM_ROWS, min(STREAM_ROWS_MOST, -(-messages // STREAM_BATCHES)))


def streamed(spark, sf_dir):
    """The faulted messages, replayed in arrival order through the stateful stream: (tables, checkpoint)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _streams:
            base = scratch_path(spark, "stream")
            messages = faulty_messages(faulted(spark, sf_dir), **PAYLOAD_FAULTS).withColumnRenamed("seq", "offset")
            write_replay(messages, f"{base}/replay", BUCKET_SECONDS, CFG,
                         rows_per_trigger=stream_rows(faulted(spark, sf_dir).count()))
            job.start(job.replay_readings(spark, f"{base}/replay", CFG), f"{base}/out", f"{base}/checkpoint", CFG) \
                .awaitTermination()
            _streams[key] = (job.read_tables(spark, f"{base}/out"), f"{base}/checkpoint")
        return _streams[key]


def q_stream_pipeline(spark, sf_dir):
    """The rows that the stream leaves in the four tables."""
    t, _ = streamed(spark, sf_dir)
    return _four_tables(t, detected_by=True)


def q_stream_handover(spark, sf_dir):
    """T6 + T11: a batch run over the first half of the time, its state handed to a stream over the rest; the rows
    that both leave in the four tables."""
    base = scratch_path(spark, "handover")
    rows = parsed(spark, sf_dir)
    lo, hi = rows.agg(F.min(F.unix_micros("arrival_ts")), F.max(F.unix_micros("arrival_ts"))).first()
    cut = ((lo or 0) + (hi or 0)) // 2 // (BUCKET_SECONDS * 1_000_000)
    first = route(rows.where(F.unix_micros("arrival_ts") < cut * BUCKET_SECONDS * 1_000_000), CFG, BUCKET_SECONDS,
                  out_path=f"{base}/routed", closing=False)
    for table, part in (("validated_readings", first.validated), ("late_events", first.late_events),
                        ("gap_alerts", first.gap_alerts), ("metrics", first.metrics)):
        T.write_batch(part, f"{base}/out/{table}", table, 0, "batch")
    messages = faulty_messages(faulted(spark, sf_dir), **PAYLOAD_FAULTS).withColumnRenamed("seq", "offset")
    late_part = rows.where(F.unix_micros("arrival_ts") >= cut * BUCKET_SECONDS * 1_000_000).count()
    write_replay(messages, f"{base}/replay", BUCKET_SECONDS, CFG, rows_per_trigger=stream_rows(late_part), since_bucket=cut)
    initial = job.handed_over(first.meter_state, first.final_wm_us, CFG)
    job.start(job.replay_readings(spark, f"{base}/replay", CFG), f"{base}/out", f"{base}/checkpoint", CFG, initial=initial).awaitTermination()
    return _four_tables(job.read_tables(spark, f"{base}/out"), detected_by=True)


def _four_tables(t, detected_by: bool = False):
    """The rows of the four tables as one; a consumer of the topics does not learn what detected a gap."""
    def rows(table, detail, number, value):
        return t[table].select(F.lit(table).alias("route"), "time" if table != "metrics" else
                               F.lit(None).cast("timestamp").alias("time"), "meter_id", detail.alias("detail"),
                               number.cast("bigint").alias("number"), value.cast("double").alias("value"))
    none = F.lit(None)
    by = F.col("detected_by") if detected_by else none.cast("string")
    return (rows("validated_readings", F.col("status"), none, F.col("consumption_kwh"))
            .unionAll(rows("late_events", none.cast("string"), F.col("delay_seconds"), F.col("consumption_kwh")))
            .unionAll(rows("gap_alerts", by, F.col("gap_minutes"), F.unix_micros("missing_to").cast("double")))
            .unionAll(rows("metrics", F.concat_ws(":", "metric_type", F.coalesce(F.element_at("tags", "error"),
                                                                              F.element_at("tags", "status"))),
                           none, F.col("value"))))


def q_stream_state(spark, sf_dir):
    """The meters' state as the stream's state store has it after the last batch."""
    state = job.read_state(spark, streamed(spark, sf_dir)[1])
    return state.select(F.col("key._key").alias("meter_id"), F.timestamp_micros("value.last_seen_us").alias("last_seen"),
                        F.col("value.gap_count").alias("gap_count"), F.col("value.late_count").alias("late_count"))


def q_consume_results(spark, sf_dir):
    """S6 + S7: the routed run's result messages, all of them sent twice, consumed into the four tables."""
    base = scratch_path(spark, "consume")
    r = routes(spark, sf_dir)
    sent = job.identified_messages({"validated_readings": r.validated, "gap_alerts": r.gap_alerts,
                                    "late_events": r.late_events, "metrics": r.metrics})
    sent = sent.repartitionByRange("position", "message_id").sortWithinPartitions("position", "message_id")
    sent = materialize(sent.select("topic", "key", "value", F.monotonically_increasing_id().alias("offset"), "message_id",
                                   F.lit(NOW).cast("timestamp").alias("sent_ts")))
    newest, most = 0, files_for(sent.count())
    for k in range(2):
        newest = write_after(sent.coalesce(most), f"{base}/topics/chunk={k}", newest)
    files = len(spark.read.parquet(f"{base}/topics/chunk=0").inputFiles())  # as many as the other chunk has
    messages = spark.readStream.schema(job.RESULT_MESSAGE + ", chunk INT").option("maxFilesPerTrigger", files).parquet(f"{base}/topics")
    job.consume_results(messages.drop("chunk"), f"{base}/out", f"{base}/checkpoint", once_within="1 hour").awaitTermination()
    return _four_tables(job.read_tables(spark, f"{base}/out"))


def q_result_payloads(spark, sf_dir):
    """S6 + P6: the routed run's rows as messages of the four result topics."""
    r = routes(spark, sf_dir)
    return job.result_topic_messages({"validated_readings": r.validated, "gap_alerts": r.gap_alerts,
                                      "late_events": r.late_events, "metrics": r.metrics})


# -- reports -----------------------------------------------------------------

def _t(spark, sf_dir, name):
    return tables(spark, sf_dir)[name]


def q_active_meter_count(spark, sf_dir):
    return Q.active_meter_count(_t(spark, sf_dir, "validated"), NOW)


def q_events_per_minute(spark, sf_dir):
    return Q.events_per_minute(_t(spark, sf_dir, "validated"), T_FROM, T_TO)


def q_gaps_per_hour(spark, sf_dir):
    return Q.gaps_per_hour(_t(spark, sf_dir, "gap_alerts"), T_FROM, T_TO)


def q_late_pct_hourly(spark, sf_dir):
    return Q.late_pct_hourly(_t(spark, sf_dir, "late_events"), _t(spark, sf_dir, "validated"), T_FROM, T_TO)


def q_top_gap_meters(spark, sf_dir):
    return Q.top_gap_meters(_t(spark, sf_dir, "gap_alerts"), T_FROM, T_TO)


def q_status_counts(spark, sf_dir):
    return Q.status_counts(_t(spark, sf_dir, "validated"), NOW)


def q_meter_list(spark, sf_dir):
    return Q.meter_list(_t(spark, sf_dir, "validated"))


def q_consumption_series(spark, sf_dir):
    return Q.consumption_series(_t(spark, sf_dir, "validated"), T_FROM, T_TO)


def q_gap_series(spark, sf_dir):
    return Q.gap_series(_t(spark, sf_dir, "gap_alerts"), T_FROM, T_TO)


def q_late_series(spark, sf_dir):
    return Q.late_series(_t(spark, sf_dir, "late_events"), T_FROM, T_TO)


DRILL_METER = "METER_0007"


def q_meter_drill_down(spark, sf_dir):
    """One meter's consumption series (the drill-down dashboard with a meter chosen)."""
    return Q.consumption_series(_t(spark, sf_dir, "validated"), T_FROM, T_TO, DRILL_METER)


def q_meter_stats(spark, sf_dir):
    return Q.meter_stats(_t(spark, sf_dir, "validated"), T_FROM, T_TO)


def q_processing_series(spark, sf_dir):
    return Q.processing_series(_t(spark, sf_dir, "metrics"), T_FROM, T_TO)


def q_error_rate(spark, sf_dir):
    return Q.error_rate(_t(spark, sf_dir, "metrics"), T_FROM, T_TO)


def q_gap_rate(spark, sf_dir):
    return Q.gap_rate(_t(spark, sf_dir, "metrics"), T_FROM, T_TO)


def q_late_rate(spark, sf_dir):
    return Q.late_rate(_t(spark, sf_dir, "metrics"), T_FROM, T_TO)


def q_metric_types(spark, sf_dir):
    return Q.metric_types(_t(spark, sf_dir, "metrics"), T_FROM, T_TO)


def q_active_meters(spark, sf_dir):
    return Q.active_meters(_t(spark, sf_dir, "validated"), NOW)


def q_active_meters_sql(spark, sf_dir):
    """U3 + A17: the table function, called from SQL."""
    t = tables(spark, sf_dir)
    SQL.register(spark, {"validated_readings": t["validated"], "gap_alerts": t["gap_alerts"],
                         "late_events": t["late_events"], "metrics": t["metrics"]})
    return spark.sql(f"SELECT * FROM get_active_meters(24, TIMESTAMP '{NOW}')")


QUERIES = {
    "csv_alias_parse": q_csv_alias_parse,
    "csv_alias_streamed": q_csv_alias_streamed,
    "stream_batch_counts": q_stream_batch_counts,
    "format_convert": q_format_convert,
    "json_parse": q_json_parse,
    "synth_readings": q_synth_readings,
    "validate": q_validate,
    "quarantine_metrics": q_quarantine_metrics,
    "inject_faults": q_inject_faults,
    "batch_watermark": q_batch_watermark,
    "classify_lateness": q_classify_lateness,
    "late_events": q_late_events,
    "validated_readings": q_validated_readings,
    "gap_events": q_gap_events,
    "expected_next": q_expected_next,
    "missing_intervals": q_missing_intervals,
    "missing_intervals_as_written": q_missing_intervals_as_written,
    "silence_alerts": q_silence_alerts,
    "resume_alerts": q_resume_alerts,
    "timer_alerts": q_timer_alerts,
    "meter_state": q_meter_state,
    "metrics_stream": q_metrics_stream,
    "validated_table": q_validated_table,
    "gap_alerts_table": q_gap_alerts_table,
    "late_events_table": q_late_events_table,
    "gap_summary_hourly": q_gap_summary_hourly,
    "late_summary_hourly": q_late_summary_hourly,
    "metrics_summary_hourly": q_metrics_summary_hourly,
    "rollup_refresh": q_rollup_refresh,
    "rollup_refreshed": q_rollup_refreshed,
    "tables_incremental": q_tables_incremental,
    "stream_pipeline": q_stream_pipeline,
    "stream_state": q_stream_state,
    "stream_handover": q_stream_handover,
    "result_payloads": q_result_payloads,
    "active_meter_count": q_active_meter_count,
    "events_per_minute": q_events_per_minute,
    "gaps_per_hour": q_gaps_per_hour,
    "late_pct_hourly": q_late_pct_hourly,
    "top_gap_meters": q_top_gap_meters,
    "status_counts": q_status_counts,
    "meter_list": q_meter_list,
    "consumption_series": q_consumption_series,
    "gap_series": q_gap_series,
    "late_series": q_late_series,
    "meter_drill_down": q_meter_drill_down,
    "meter_stats": q_meter_stats,
    "processing_series": q_processing_series,
    "error_rate": q_error_rate,
    "gap_rate": q_gap_rate,
    "late_rate": q_late_rate,
    "metric_types": q_metric_types,
    "active_meters": q_active_meters,
    "active_meters_sql": q_active_meters_sql,
    "rollup_streamed": q_rollup_streamed,
    "consume_results": q_consume_results,
}
