"""The command line, in its own process (it owns its session)."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    r = subprocess.run([sys.executable, "-m", "tsquality", *args], cwd=ROOT, capture_output=True, text=True,
                       timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]


def test_replay_stream_equals_batch(tmp, spark):
    """generate -> replay -> stream and batch: the same late events, LATE readings and alerts; then
    compaction and a report."""
    from tsquality.operators import tables as T
    sample, replay = os.path.join(tmp, "sample"), os.path.join(tmp, "replay")
    _run("generate", sample, "--meters", "3", "--days", "1", "--start", "2024-01-01")
    _run("replay", sample, replay, "--bucket-seconds", "10800", "--delay-p", "0.3", "--max-delay", "21600", "--gap-p", "0.1")
    stream, batch = os.path.join(tmp, "stream"), os.path.join(tmp, "batch")
    _run("stream", replay, stream, os.path.join(tmp, "ckpt"))
    _run("batch", replay, batch, "--format", "replay", "--bucket-seconds", "10800")
    assert sorted(os.listdir(batch)) == ["gap_alerts", "late_events", "meter_state", "metrics", "validated_readings"]

    def rows(base, table, cols):
        return sorted(map(tuple, T.read_table(spark, f"{base}/{table}", table).select(cols).collect()))
    for table, cols in (("late_events", ["time", "meter_id", "delay_seconds"]),
                        ("validated_readings", ["time", "meter_id", "status", "arrival_ts"]),
                        ("gap_alerts", ["time", "meter_id", "missing_to", "gap_minutes", "detected_by"])):
        assert rows(stream, table, cols) == rows(batch, table, cols) != []
    assert any(r[2] == "LATE" for r in rows(batch, "validated_readings", ["time", "meter_id", "status"]))
    compacted = os.path.join(tmp, "compacted")
    _run("compact", batch, "validated_readings", f"{compacted}/validated_readings")
    report = os.path.join(tmp, "report")
    _run("report", compacted, "meter_stats", "--from", "2024-01-01", "--to", "2024-01-03", "--out", report)
    assert spark.read.option("header", True).csv(report).count() == 3


def test_run_parameters(tmp):
    import json

    import pytest
    from tsquality.config import load_config
    path = os.path.join(tmp, "run.json")
    with open(path, "w") as f:
        json.dump({"interval_minutes": 15, "max_kwh": 5}, f)
    cfg = load_config(path, ["grace_seconds=60"])
    assert (cfg.interval_minutes, cfg.max_kwh, cfg.grace_seconds, cfg.ttl_days) == (15, 5.0, 60, 7)
    with pytest.raises(ValueError):
        load_config(None, ["no_such=1"])
