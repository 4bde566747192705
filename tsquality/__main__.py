"""Command line: the reference's entry points, as Spark jobs.

  python -m tsquality generate OUT.csv [--meters 10 --days 7 --interval 30 --start 2024-01-01]
  python -m tsquality convert IN.csv OUT_DIR            third-party CSV -> standard CSV
  python -m tsquality replay IN.csv OUT_DIR [--bucket-seconds 60 --gap-p 0.05 --delay-p 0.1 --max-delay 300]
                                                        CSV -> messages by arrival bucket, and their order
  python -m tsquality stream SRC_DIR OUT_DIR CKPT [--format replay|json|parquet] [--continuous]
                                                        replay / messages / readings -> four tables (stateful stream)
  python -m tsquality batch SRC OUT_DIR [--format csv|replay] [--bucket-seconds 60]
                                                        the same flow as one batch run (arrival buckets)
  python -m tsquality compact TABLE_DIR TABLE OUT_DIR   resolve keys, by day, what is new since the last time
  python -m tsquality refresh TABLE_DIR ROLLUP OUT_DIR NOW   hourly rollup refresh window
  python -m tsquality report TABLE_DIR NAME [--from T --to T --now T --meter M --out DIR]
                                                        a dashboard query over compacted tables, as CSV

Run parameters (``config.QualityConfig``) come from ``--config FILE.json`` and, over that, from
``--set name=value``, for example ``--set interval_minutes=15 --set grace_seconds=600``.
Kafka needs the connector jar on the classpath (see ``sources.messages``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import inspect
import uuid

from pyspark.sql import functions as F

from tsquality.config import load_config
from tsquality.session import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tsquality")
    p.add_argument("--config", default=None, help="JSON file of run parameters")
    p.add_argument("--set", action="append", default=[], metavar="NAME=VALUE")
    sub = p.add_subparsers(dest="cmd", required=True)
    g = sub.add_parser("generate")
    g.add_argument("out")
    g.add_argument("--meters", type=int, default=10)
    g.add_argument("--days", type=int, default=7)
    g.add_argument("--interval", type=int, default=30)
    g.add_argument("--start", default=None)
    c = sub.add_parser("convert")
    c.add_argument("src")
    c.add_argument("out")
    r = sub.add_parser("replay")
    r.add_argument("src")
    r.add_argument("out")
    r.add_argument("--bucket-seconds", type=int, default=60)
    r.add_argument("--gap-p", type=float, default=0.05)
    r.add_argument("--delay-p", type=float, default=0.1)
    r.add_argument("--max-delay", type=int, default=300)
    r.add_argument("--seed", type=int, default=42)
    s = sub.add_parser("stream")
    s.add_argument("src")
    s.add_argument("out")
    s.add_argument("checkpoint")
    s.add_argument("--format", default="replay", choices=["replay", "json", "parquet"])
    s.add_argument("--continuous", action="store_true")
    s.add_argument("--files-per-trigger", type=int, default=None,
                   help="cuts micro-batches, which moves the watermark; none by default")
    s.add_argument("--kafka", default=None, metavar="SERVERS", help="also send the four result topics")
    b = sub.add_parser("batch")
    b.add_argument("src")
    b.add_argument("out")
    b.add_argument("--format", default="csv", choices=["csv", "replay"])
    b.add_argument("--bucket-seconds", type=int, default=60)
    k = sub.add_parser("compact")
    k.add_argument("src")
    k.add_argument("table")
    k.add_argument("out")
    f = sub.add_parser("refresh")
    f.add_argument("src")
    f.add_argument("rollup")
    f.add_argument("out")
    f.add_argument("now")
    q = sub.add_parser("report")
    q.add_argument("src")
    q.add_argument("name", choices=sorted(REPORTS))
    for flag in ("from", "to", "now"):
        q.add_argument(f"--{flag}", dest=f"t_{flag}", type=dt.datetime.fromisoformat, default=None)
    q.add_argument("--meter", default=None)
    q.add_argument("--out", default=None)
    return p


#: Report queries (``plans.reports``) and the compacted tables they read.
REPORTS = {
    "active_meter_count": ["validated_readings"], "events_per_minute": ["validated_readings"],
    "gaps_per_hour": ["gap_alerts"], "late_pct_hourly": ["late_events", "validated_readings"],
    "top_gap_meters": ["gap_alerts"], "status_counts": ["validated_readings"], "meter_list": ["validated_readings"],
    "consumption_series": ["validated_readings"], "gap_series": ["gap_alerts"], "late_series": ["late_events"],
    "meter_stats": ["validated_readings"], "processing_series": ["metrics"], "error_rate": ["metrics"],
    "gap_rate": ["metrics"], "late_rate": ["metrics"], "metric_types": ["metrics"], "active_meters": ["validated_readings"],
}


def _report(spark, a):
    from tsquality.operators.tables import read_compacted
    from tsquality.plans import reports
    fn = getattr(reports, a.name)
    now = a.t_now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    given = {"now": now, "t_to": a.t_to or now, "t_from": a.t_from or (a.t_to or now) - dt.timedelta(days=30)}
    tables = [read_compacted(spark, f"{a.src}/{t}", t) for t in REPORTS[a.name]]
    args = {n: given[n] for n in inspect.signature(fn).parameters if n in given}
    if a.meter is not None:
        args["meter_id"] = a.meter
    df = fn(*tables, **args)
    if a.out:
        df.write.mode("overwrite").option("header", True).csv(a.out)
    else:
        df.show(1000, truncate=False)


def main(argv=None):
    a = _parser().parse_args(argv)
    cfg = load_config(a.config, a.set)
    spark = build_session(app=f"tsquality-{a.cmd}")
    if a.cmd == "generate":
        from tsquality.sources.csv import write_standard_csv
        from tsquality.sources.synth import generate_readings
        start = dt.datetime.fromisoformat(a.start) if a.start else \
            (dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(days=a.days)).replace(microsecond=0)
        df = generate_readings(spark, start, a.meters, a.days, a.interval)
        write_standard_csv(df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")), a.out)
    elif a.cmd == "convert":
        from tsquality.sources.csv import convert_to_standard, read_csv, write_standard_csv
        write_standard_csv(convert_to_standard(read_csv(spark, a.src)), a.out)
    elif a.cmd == "replay":
        from pyspark.sql import Observation

        from tsquality.sources.csv import parse_csv_rows, read_csv
        from tsquality.sources.messages import to_messages
        from tsquality.sources.replay import write_replay
        from tsquality.sources.synth import inject_faults, replay_order
        seen = Observation("csv")
        rows = replay_order(parse_csv_rows(read_csv(spark, a.src), observation=seen).withColumn(
            "seq", F.monotonically_increasing_id()))
        f = inject_faults(rows, a.seed, a.gap_p, a.delay_p, a.max_delay)
        n = write_replay(to_messages(f, keep=("seq", "arrival_ts")).withColumnRenamed("seq", "offset"), a.out, a.bucket_seconds, cfg)
        print(f"{n} chunks; {seen.get['dropped']} of {seen.get['rows']} rows dropped")
    elif a.cmd == "stream":
        from tsquality.streaming import job
        if a.format == "replay":
            src = job.replay_readings(spark, a.src, cfg)
        elif a.format == "json":
            src = job.message_readings(spark, a.src, files_per_trigger=a.files_per_trigger, cfg=cfg)
        else:
            src = job.file_readings(spark, a.src, files_per_trigger=a.files_per_trigger)
        job.start(src, a.out, a.checkpoint, cfg, available_now=not a.continuous, servers=a.kafka).awaitTermination()
    elif a.cmd == "batch":
        from tsquality.operators.tables import write_batch
        from tsquality.plans.routing import route
        if a.format == "csv":
            from tsquality.sources.csv import parse_csv_rows, read_csv
            rows = parse_csv_rows(read_csv(spark, a.src)).select(
                "*", F.monotonically_increasing_id().alias("seq"), F.col("timestamp").alias("arrival_ts"))
        else:
            from tsquality.sources.messages import parse_readings
            from tsquality.sources.replay import stored_messages
            rows = parse_readings(stored_messages(spark, a.src), cfg).withColumnRenamed("offset", "seq").drop("key", "value")
        r, run = route(rows, cfg, a.bucket_seconds), uuid.uuid4().hex
        for table, df in (("validated_readings", r.validated), ("late_events", r.late_events),
                          ("gap_alerts", r.gap_alerts), ("metrics", r.metrics)):
            write_batch(df, f"{a.out}/{table}", table, 0, run)
        r.meter_state.write.mode("overwrite").parquet(f"{a.out}/meter_state")
    elif a.cmd == "compact":
        from tsquality.operators.tables import compact
        compact(spark, f"{a.src}/{a.table}", a.table, a.out)
    elif a.cmd == "refresh":
        from tsquality.operators.rollups import refresh
        from tsquality.operators.tables import read_table
        table = {"gap_summary_hourly": "gap_alerts", "late_events_summary_hourly": "late_events",
                 "metrics_summary_hourly": "metrics"}[a.rollup]
        refresh(read_table(spark, f"{a.src}/{table}", table), a.rollup, a.out, dt.datetime.fromisoformat(a.now))
    elif a.cmd == "report":
        _report(spark, a)
    spark.stop()


if __name__ == "__main__":
    main()
