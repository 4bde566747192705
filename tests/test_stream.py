"""Stream = batch: the stateful stream fed one arrival bucket per trigger must
write the same tables as the routed batch plan (SURVEY 5, layer 3)."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tsquality.config import DEFAULT, QualityConfig
from tsquality.operators import tables as T
from tsquality.plans.routing import route
from tsquality.sources.events import load_readings
from tsquality.sources.synth import inject_faults
from tsquality.streaming import job

from conftest import SF_ORACLE, SF_SMALL
from helpers import readings


def write_buckets(spark, df, folder, bucket_seconds):
    """One parquet file per arrival bucket, modification times in bucket order (test replay)."""
    os.makedirs(folder)
    pdf = df.select("meter_id", "timestamp", "consumption_kwh", "seq", "arrival_ts").toPandas()
    pdf["_b"] = pdf["arrival_ts"].astype("int64") // 1000 // (bucket_seconds * 1_000_000)
    schema = pa.schema([("meter_id", pa.string()), ("timestamp", pa.timestamp("us", tz="UTC")),
                        ("consumption_kwh", pa.float64()), ("seq", pa.int64()),
                        ("arrival_ts", pa.timestamp("us", tz="UTC"))])
    for i, (b, g) in enumerate(sorted(pdf.groupby("_b"), key=lambda x: x[0])):
        g = g.drop(columns="_b").copy()
        for c in ("timestamp", "arrival_ts"):
            g[c] = g[c].dt.tz_localize("UTC") if g[c].dt.tz is None else g[c]
        p = os.path.join(folder, f"b{i:05d}.parquet")
        pq.write_table(pa.Table.from_pandas(g, schema=schema, preserve_index=False), p)
        os.utime(p, (1_600_000_000 + 10 * i, 1_600_000_000 + 10 * i))
    return i + 1


def run_stream(spark, folder, base, cfg):
    q = job.start(job.file_readings(spark, folder, files_per_trigger=1), os.path.join(base, "out"), os.path.join(base, "ckpt"), cfg)
    q.awaitTermination()
    return job.read_tables(spark, os.path.join(base, "out"))


def test_fixture_sequence(spark, tmp):
    rows = [("a", "2024-01-01 10:00:00", 1.0, "2024-01-01 00:00:00"),
            ("b", "2024-01-01 14:00:00", 1.0, "2024-01-01 01:00:00"),
            ("b", "2024-01-01 14:30:00", 1.0, "2024-01-01 02:00:00"),
            ("a", "2024-01-01 14:20:00", 1.0, "2024-01-01 03:00:00"),
            ("a", "2024-01-01 11:00:00", 1.0, "2024-01-01 03:00:00"),
            ("b", "2024-01-01 15:00:00", 1.0, "2024-01-01 04:00:00")]
    df = readings(spark, rows)
    write_buckets(spark, df, os.path.join(tmp, "src"), 3600)
    t = run_stream(spark, os.path.join(tmp, "src"), tmp, DEFAULT)
    v = {(r.meter_id, r.time.strftime("%H:%M")): r.status for r in t["validated_readings"].collect()}
    assert v[("a", "14:20")] == "LATE"
    assert ("a", "11:00") not in v
    late = t["late_events"].collect()
    assert [(r.meter_id, r.delay_seconds) for r in late] == [("a", 12600)]
    # Same rows from the batch twin.
    r = route(df, DEFAULT, 3600)
    assert sorted(x.delay_seconds for x in r.late_events.collect()) == [12600]
    alerts = t["gap_alerts"].orderBy("missing_from").collect()
    assert [a.missing_from.strftime("%H:%M") for a in alerts][:3] == ["10:30", "11:00", "11:30"]
    st = {x.key[0]: x.value for x in job.read_state(spark, os.path.join(tmp, "ckpt")).collect()}
    assert st["a"]["gap_count"] == 8 and st["a"]["late_count"] == 1


def _norm(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=str)


def test_stream_equals_batch(spark, tmp):
    cfg = QualityConfig(interval_minutes=480, materialize="cache")
    bucket = 3 * 86400
    raw = inject_faults(load_readings(spark, SF_SMALL), seed=7, gap_probability=0.05, delay_probability=0.2,
                        max_delay_seconds=5 * 86400, corrupt_probability=0.02)
    n = write_buckets(spark, raw, os.path.join(tmp, "src"), bucket)
    assert n >= 8
    streamed = run_stream(spark, os.path.join(tmp, "src"), tmp, cfg)
    twin = route(raw, cfg, bucket)

    vcols = ["time", "meter_id", "consumption_kwh", "status"]
    assert _norm(streamed["validated_readings"], vcols) == _norm(T.resolve_routed(twin.validated, "validated_readings"), vcols)
    lcols = ["time", "meter_id", "event_timestamp", "consumption_kwh", "delay_seconds"]
    assert _norm(streamed["late_events"], lcols) == _norm(twin.late_events, lcols)
    assert twin.late_events.count() > 0
    gcols = ["time", "meter_id", "missing_from", "missing_to", "gap_minutes", "detected_by"]
    got = _norm(streamed["gap_alerts"], gcols)
    want = _norm(T.resolve_routed(twin.gap_alerts, "gap_alerts"), gcols)
    assert got == want
    assert any(g[5] == "timer" for g in got) and any(g[5] == "event" for g in got)
    mcols = ["metric_type", "meter_id", "value"]
    assert _norm(streamed["metrics"], mcols) == _norm(twin.metrics, mcols)

    state = job.read_state(spark, os.path.join(tmp, "ckpt")).select(
        F.col("key._key").alias("meter_id"), "value.*")
    got_state = sorted((r.meter_id, r.last_seen_us, r.gap_count, r.late_count) for r in state.collect())
    want_state = sorted((r.meter_id, int(r.last_seen.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6),
                         r.gap_count, r.late_count) for r in twin.meter_state.collect())
    assert got_state == want_state


def test_ttl_expiry_stream_equals_batch(spark, tmp):
    """A meter silent for more than the 7-day TTL: its cascade stops at the TTL, its
    state is cleared, and its next reading starts a new life (no resume alert)."""
    base = dt.datetime(2024, 1, 1)
    rows = [("A", base, 1.0, base)]
    for h in range(0, 12 * 24, 12):                       # B every 12 hours for 12 days
        t = base + dt.timedelta(hours=h + 1)
        rows.append(("B", t, 1.0, t))
    t = base + dt.timedelta(days=10)
    rows.append(("A", t, 1.0, t))                          # A resumes after 10 days
    rows.append(("A", base + dt.timedelta(days=9, hours=20), 1.0, t + dt.timedelta(hours=1)))  # too late
    df = spark.createDataFrame([(m, ts, v, i, a) for i, (m, ts, v, a) in enumerate(rows)],
                               "meter_id string, timestamp timestamp, consumption_kwh double, seq bigint, "
                               "arrival_ts timestamp")
    cfg = QualityConfig(interval_minutes=360, materialize="cache")
    bucket = 12 * 3600
    write_buckets(spark, df, os.path.join(tmp, "src"), bucket)
    streamed = run_stream(spark, os.path.join(tmp, "src"), tmp, cfg)
    twin = route(df, cfg, bucket)
    gcols = ["meter_id", "missing_from", "missing_to", "gap_minutes", "detected_by"]
    got = _norm(streamed["gap_alerts"], gcols)
    assert got == _norm(T.resolve_routed(twin.gap_alerts, "gap_alerts"), gcols)
    a_alerts = [g for g in got if g[0] == "A"]
    # First life: steps of 6 h from day 0 up to the TTL, (7 d - 15 min) / 6 h -> 27 steps.
    # No resume alert at day 10 (state expired); the new life cascades up to the final
    # watermark (B's last reading, day 11 13:00): 6 more steps.
    first = [g for g in a_alerts if g[1] < base + dt.timedelta(days=10)]
    assert len(first) == 27 and len(a_alerts) == 33 and all(g[4] == "timer" for g in a_alerts)
    lcols = ["meter_id", "time", "delay_seconds"]
    assert _norm(streamed["late_events"], lcols) == _norm(twin.late_events, lcols)
    state = job.read_state(spark, os.path.join(tmp, "ckpt")).select(F.col("key._key").alias("meter_id"), "value.*")
    got_state = sorted((r.meter_id, r.gap_count, r.late_count) for r in state.collect())
    want_state = sorted((r.meter_id, r.gap_count, r.late_count) for r in twin.meter_state.collect())
    assert got_state == want_state


def _replay(spark, tmp, bucket, rows_per_trigger):
    from tsquality.plans import catalog as C
    from tsquality.sources.replay import write_replay
    from tsquality.sources.synth import faulty_messages
    raw = inject_faults(load_readings(spark, SF_SMALL), seed=9, delay_probability=0.3, max_delay_seconds=4 * 86400,
                        corrupt_probability=0.02, repeat_probability=0.05)
    messages = faulty_messages(raw, seed=9, probability=0.05).withColumnRenamed("seq", "offset")
    n = write_replay(messages, os.path.join(tmp, "replay"), bucket, C.CFG, rows_per_trigger, rows_per_file=40)
    assert C.CFG.interval_minutes == 480
    return n, C.CFG


def _tables(t):
    return {"validated": _norm(t["validated_readings"], ["time", "meter_id", "consumption_kwh", "status"]),
            "late": _norm(t["late_events"], ["time", "meter_id", "consumption_kwh", "delay_seconds"]),
            "gaps": _norm(t["gap_alerts"], ["meter_id", "missing_from", "missing_to", "gap_minutes", "detected_by"]),
            "metrics": sorted(map(str, _norm(t["metrics"], ["metric_type", "meter_id", "value"])))}


def _batch_tables(spark, tmp, cfg, bucket):
    from tsquality.sources.messages import parse_readings
    from tsquality.sources.replay import stored_messages
    rows = parse_readings(stored_messages(spark, os.path.join(tmp, "replay")), cfg).withColumnRenamed("offset", "seq")
    r = route(rows.drop("key", "value"), cfg, bucket)
    return _tables({"validated_readings": T.resolve_routed(r.validated, "validated_readings"),
                    "late_events": T.resolve_routed(r.late_events, "late_events"),
                    "gap_alerts": T.resolve_routed(r.gap_alerts, "gap_alerts"), "metrics": r.metrics})


def _state(spark, checkpoint):
    state = job.read_state(spark, checkpoint).select(F.col("key._key").alias("meter_id"), "value.*")
    return sorted((r.meter_id, r.last_seen_us, r.gap_count, r.late_count) for r in state.collect())


@pytest.mark.parametrize("bucket, rows_per_trigger", [(4 * 86400, 1), (6 * 3600, 300)])
def test_replay_restarted_from_its_checkpoint_equals_batch(spark, tmp, bucket, rows_per_trigger):
    """The stream stops after some chunks, resumes with the same checkpoint, and ends with the tables of the
    batch run: with a bucket a micro-batch, and with many. Several files make up a chunk."""
    import glob
    import shutil
    n, cfg = _replay(spark, tmp, bucket, rows_per_trigger)
    part = os.path.join(tmp, "part")
    shutil.copytree(os.path.join(tmp, "replay", "about"), os.path.join(part, "about"))
    folders = sorted(glob.glob(os.path.join(tmp, "replay", "messages", "chunk=*")))
    assert len(folders) == n and len(glob.glob(folders[0] + "/slot=*/part-*")) > 1
    buckets = spark.read.parquet(os.path.join(tmp, "replay", "messages")).where("NOT mark").select("bucket").distinct().count()
    assert buckets >= 7 and (n == buckets if rows_per_trigger == 1 else 3 <= n < buckets / 8)
    quiet = "spark.sql.streaming.noDataMicroBatches.enabled"
    for some in (folders[:2], folders[2:]):
        # A stop in mid-stream has no closing batch without rows, which would fire timers before the next rows.
        spark.conf.set(quiet, str(some[-1] == folders[-1]).lower())
        for f in some:
            shutil.copytree(f, os.path.join(part, "messages", os.path.basename(f)), copy_function=shutil.copy2)
        q = job.start(job.replay_readings(spark, part, cfg), os.path.join(tmp, "out"), os.path.join(tmp, "ckpt"), cfg, state_partitions=3)
        q.awaitTermination()
        batches = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
        assert len(batches) == len(some)
    got, want = _tables(job.read_tables(spark, os.path.join(tmp, "out"))), _batch_tables(spark, tmp, cfg, bucket)
    assert got == want
    assert got["late"] and any(r[3] == "LATE" for r in got["validated"]) and {r[4] for r in got["gaps"]} == {"event", "timer"}
    assert {m.split("'")[1] for m in got["metrics"]} >= {"processing_error", "invalid_event", "too_late_event"}


def _fed(spark, tmp, name, rows, bucket, rows_per_trigger, cfg):
    """(tables, state) of a streamed replay of readings."""
    from tsquality.sources.messages import to_messages
    from tsquality.sources.replay import write_replay
    base = os.path.join(tmp, name)
    messages = to_messages(rows, keep=("seq", "arrival_ts")).withColumnRenamed("seq", "offset")
    n = write_replay(messages, f"{base}/replay", bucket, cfg, rows_per_trigger)
    job.start(job.replay_readings(spark, f"{base}/replay", cfg), f"{base}/out", f"{base}/ckpt", cfg, state_partitions=2).awaitTermination()
    return n, _tables(job.read_tables(spark, f"{base}/out")), _state(spark, f"{base}/ckpt")


def test_many_buckets_a_micro_batch_equal_one(spark, tmp):
    """Lives that end inside a micro-batch, late and too late rows of them, repeated keys in two buckets: the
    same tables and state for a bucket a trigger, some and all of them."""
    import random
    rng = random.Random(11)
    base, rows = dt.datetime(2024, 1, 1), []
    for meter, every in (("A", 12), ("B", 2 * 24), ("C", 9 * 24), ("D", 5)):
        for h in range(0, 20 * 24, every):
            t = base + dt.timedelta(hours=h + rng.choice([0, 0, 1, 4]))
            for _ in range(rng.choice([1, 1, 2])):
                rows.append((meter, t, float(rng.randint(1, 9)), t + dt.timedelta(hours=rng.choice([0, 0, 0, 1, 30, 200]))))
    df = spark.createDataFrame([(m, t, v, i, a) for i, (m, t, v, a) in enumerate(rows)],
                               "meter_id string, timestamp timestamp, consumption_kwh double, seq bigint, arrival_ts timestamp")
    cfg = QualityConfig(interval_minutes=360, allowed_lateness_seconds=36 * 3600, materialize="cache")
    bucket = 36 * 3600
    runs = [_fed(spark, tmp, f"run{k}", df, bucket, k, cfg) for k in (1, 60, 100_000)]
    assert runs[0][0] > 12 and runs[0][0] > runs[1][0] > runs[2][0] == 1
    twin = route(df, cfg, bucket)
    want = _tables({"validated_readings": T.resolve_routed(twin.validated, "validated_readings"),
                    "late_events": T.resolve_routed(twin.late_events, "late_events"),
                    "gap_alerts": T.resolve_routed(twin.gap_alerts, "gap_alerts"), "metrics": twin.metrics})
    state = sorted((r.meter_id, int(r.last_seen.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6), r.gap_count, r.late_count)
                   for r in twin.meter_state.collect())
    for _, tables, own in runs:
        assert tables == want and own == state
    assert want["late"] and any(r[3] == "LATE" for r in want["validated"]) and {r[4] for r in want["gaps"]} == {"event", "timer"}


def test_batch_hands_its_state_to_the_stream(spark, tmp):
    """A batch run over the first buckets, a stream with another number of state stores over the rest: the tables and
    the state of one batch run over all. Some meters are silent across the border, one beyond its TTL."""
    from tsquality.sources.messages import to_messages
    from tsquality.sources.replay import write_replay
    base, rows = dt.datetime(2024, 1, 1), []
    for meter, every, until in (("A", 12, 16), ("B", 30, 16), ("C", 5 * 24, 16), ("D", 9 * 24, 16), ("E", 12, 5), ("F", 24, 1)):
        for h in range(0, until * 24, every):
            t = base + dt.timedelta(hours=h)
            rows.append((meter, t, 1.0 + h, t + dt.timedelta(hours=40 if h % 7 == 3 else 0)))
    df = spark.createDataFrame([(m, t, v, i, a) for i, (m, t, v, a) in enumerate(rows)],
                               "meter_id string, timestamp timestamp, consumption_kwh double, seq bigint, arrival_ts timestamp")
    cfg, bucket = QualityConfig(interval_minutes=360, allowed_lateness_seconds=36 * 3600, materialize="cache"), 12 * 3600
    cut = int(base.replace(tzinfo=dt.timezone.utc).timestamp()) // bucket + 16
    first = route(df.where(F.unix_micros("arrival_ts") < cut * bucket * 1_000_000), cfg, bucket, closing=False)
    out = os.path.join(tmp, "out")
    for table, part in (("validated_readings", first.validated), ("late_events", first.late_events),
                        ("gap_alerts", first.gap_alerts), ("metrics", first.metrics)):
        T.write_batch(part, f"{out}/{table}", table, 0, "batch")
    messages = to_messages(df, keep=("seq", "arrival_ts")).withColumnRenamed("seq", "offset")
    write_replay(messages, f"{tmp}/replay", bucket, cfg, rows_per_trigger=12, since_bucket=cut)
    initial = job.handed_over(first.meter_state, first.final_wm_us, cfg)
    job.start(job.replay_readings(spark, f"{tmp}/replay", cfg), out, f"{tmp}/ckpt", cfg, state_partitions=3, initial=initial).awaitTermination()
    twin = route(df, cfg, bucket)
    assert _tables(job.read_tables(spark, out)) == _tables({
        "validated_readings": T.resolve_routed(twin.validated, "validated_readings"),
        "late_events": T.resolve_routed(twin.late_events, "late_events"),
        "gap_alerts": T.resolve_routed(twin.gap_alerts, "gap_alerts"), "metrics": twin.metrics})
    assert _state(spark, f"{tmp}/ckpt") == sorted(
        (r.meter_id, int(r.last_seen.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6), r.gap_count, r.late_count)
        for r in twin.meter_state.collect())


def test_second_run_into_one_folder_keeps_the_first(spark, tmp):
    """A fresh checkpoint counts its batches from 0; the rows of the run before stay, also by URI."""
    rows = [("a", "2024-01-01 10:00:00", 1.0), ("b", "2024-01-01 10:00:00", 1.0)]
    out = "file:" + os.path.join(tmp, "out")
    for k, row in enumerate(rows):
        src = os.path.join(tmp, f"src{k}")
        write_buckets(spark, readings(spark, [row]), src, 3600)
        job.start(job.file_readings(spark, src), out, os.path.join(tmp, f"ckpt{k}"), DEFAULT).awaitTermination()
    t = job.read_tables(spark, out)
    assert sorted(r.meter_id for r in t["validated_readings"].collect()) == ["a", "b"]


def test_streamed_query_has_the_late_rows_of_the_routed_run(spark, tmp):
    """The registered streamed run, over a day of events: late and too late rows as in the hourly run and its SQL."""
    import __spark_entry__ as E
    import duckdb
    from tools.compare import digest
    from tsquality.plans import catalog
    events = spark.read.parquet(f"{SF_ORACLE}/events.parquet")
    first = events.agg(F.min("ts")).first()[0]
    events.where(F.col("ts") < F.lit(first + dt.timedelta(days=1))).coalesce(1).write.parquet(f"{tmp}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp}/events.parquet/*.parquet')")
    for name in ("stream_pipeline", "stream_state"):
        df = E.queries()[name](spark, tmp)
        res = con.execute(E.oracle_sql()[name])
        columns = [d[0] for d in res.description]
        assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, res.fetchall())
    routed = catalog.tables(spark, tmp)
    late = routed["validated"].where("status = 'LATE'").count(), routed["late_events"].count()
    got = E.queries()["stream_pipeline"](spark, tmp)
    assert (got.where("detail = 'LATE'").count(), got.where("route = 'late_events'").count()) == late
    assert min(late) > 0
