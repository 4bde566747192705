"""Key-conflict rules (FIXTURES 3, Key conflicts) on batch-addressed table logs."""

import os

from tsquality.operators import tables as T

from helpers import ts


def test_key_rules(spark, tmp):
    t0 = ts("2024-01-01 10:00:00")
    v = os.path.join(tmp, "validated_readings")
    T.write_batch(spark.createDataFrame([(t0, "M1", 1.0, "OK", 0)], "time timestamp, meter_id string, "
                                        "consumption_kwh double, status string, seq bigint"), v, "validated_readings", 0)
    T.write_batch(spark.createDataFrame([(t0, "M1", 2.0, "LATE", 0)], "time timestamp, meter_id string, "
                                        "consumption_kwh double, status string, seq bigint"), v, "validated_readings", 1)
    r = T.read_table(spark, v, "validated_readings").collect()
    assert [(x.consumption_kwh, x.status) for x in r] == [(2.0, "LATE")]

    g = os.path.join(tmp, "gap_alerts")
    f = ts("2024-01-01 10:30:00")
    schema = "time timestamp, meter_id string, missing_from timestamp, missing_to timestamp, gap_minutes int, " \
             "detected_by string, seq bigint"
    T.write_batch(spark.createDataFrame([(f, "M1", f, ts("2024-01-01 10:45:00"), 15, "timer", 0)], schema),
                  g, "gap_alerts", 3)
    T.write_batch(spark.createDataFrame([(f, "M1", f, ts("2024-01-01 12:00:00"), 90, "event", 1)], schema),
                  g, "gap_alerts", 4)
    r = T.read_table(spark, g, "gap_alerts").collect()
    assert [(x.gap_minutes, x.detected_by) for x in r] == [(15, "timer")]

    late = os.path.join(tmp, "late_events")
    schema = "time timestamp, meter_id string, event_timestamp timestamp, consumption_kwh double, " \
             "delay_seconds int, seq bigint"
    for b, d in ((0, 4000), (1, 5000)):
        T.write_batch(spark.createDataFrame([(t0, "M1", t0, 1.0, d, 0)], schema), late, "late_events", b)
    assert [x.delay_seconds for x in T.read_table(spark, late, "late_events").collect()] == [4000]

    m = os.path.join(tmp, "metrics")
    schema = "time timestamp, metric_type string, meter_id string, value double, tags map<string,string>, seq bigint"
    T.write_batch(spark.createDataFrame([(t0, "x", "M1", 1.0, {}, 0), (t0, "x", "M1", 1.0, {}, 1)], schema),
                  m, "metrics", 0)
    assert T.read_table(spark, m, "metrics").count() == 2


def test_retry_of_a_batch_replaces_it(spark, tmp):
    t0 = ts("2024-01-01 10:00:00")
    v = os.path.join(tmp, "validated_readings")
    schema = "time timestamp, meter_id string, consumption_kwh double, status string, seq bigint"
    for _ in range(2):
        T.write_batch(spark.createDataFrame([(t0, "M1", 1.0, "OK", 0), (t0, "M2", 1.0, "OK", 1)], schema),
                      v, "validated_readings", 7)
    assert T.read_log(spark, v).count() == 2


def test_compact(spark, tmp):
    t0 = ts("2024-01-01 10:00:00")
    v = os.path.join(tmp, "validated_readings")
    schema = "time timestamp, meter_id string, consumption_kwh double, status string, seq bigint"
    T.write_batch(spark.createDataFrame([(t0, "M1", 1.0, "OK", 0)], schema), v, "validated_readings", 0)
    T.write_batch(spark.createDataFrame([(t0, "M1", 3.0, "OK", 0)], schema), v, "validated_readings", 1)
    out = T.compact(spark, v, "validated_readings", os.path.join(tmp, "compacted"))
    assert [x.consumption_kwh for x in out.collect()] == [3.0]
    assert "event_date" in out.columns


READING = "time timestamp, meter_id string, consumption_kwh double, status string, seq bigint"


def test_runs_do_not_overwrite_each_other(spark, tmp):
    t0 = ts("2024-01-01 10:00:00")
    v = "file:" + os.path.join(tmp, "validated_readings")
    for run, kwh in (("a", 1.0), ("b", 2.0)):
        T.write_batch(spark.createDataFrame([(t0, "M1", kwh, "OK", 0), (t0, run, kwh, "OK", 1)], READING), v,
                      "validated_readings", 0, run)
    assert T.read_log(spark, v, "validated_readings").count() == 4
    got = {r.meter_id: r.consumption_kwh for r in T.read_table(spark, v, "validated_readings").collect()}
    assert got == {"M1": 2.0, "a": 1.0, "b": 2.0}  # the later write wins


def test_incremental_compaction(spark, tmp):
    """Days that later writes do not touch keep their files; the result is that of a full compaction."""
    import glob
    v, out = os.path.join(tmp, "log"), os.path.join(tmp, "compacted")

    def write(batch, rows):
        T.write_batch(spark.createDataFrame([(ts(t), m, k, "OK", i) for i, (t, m, k) in enumerate(rows)], READING), v,
                      "validated_readings", batch)
    write(0, [("2024-01-01 10:00:00", "M1", 1.0), ("2024-01-02 10:00:00", "M1", 2.0)])
    T.compact(spark, v, "validated_readings", out)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(out + "/event_date=2024-01-01/part-*")}
    write(1, [("2024-01-02 10:00:00", "M1", 5.0), ("2024-01-03 10:00:00", "M1", 3.0)])
    got = T.compact(spark, v, "validated_readings", out)
    assert sorted((r.time.day, r.consumption_kwh) for r in got.collect()) == [(1, 1.0), (2, 5.0), (3, 3.0)]
    assert {f: os.stat(f).st_mtime_ns for f in glob.glob(out + "/event_date=2024-01-01/part-*")} == before
    again = T.compact(spark, v, "validated_readings", out)  # nothing new
    assert again.count() == 3
    full = T.compact(spark, v, "validated_readings", os.path.join(tmp, "full"))
    cols = ["time", "meter_id", "consumption_kwh", "status"]
    assert sorted(map(tuple, full.select(cols).collect())) == sorted(map(tuple, got.select(cols).collect()))


def test_batch_run_is_compacted_and_reported(spark, tmp):
    """A routed batch run, written as a log, has its days and its arrival times."""
    from helpers import readings
    from tsquality.config import DEFAULT
    from tsquality.plans import reports
    from tsquality.plans.routing import route
    rows = readings(spark, [("A", "2024-01-01 10:00:00", 1.0, "2024-01-01 10:20:00"), ("A", "2024-01-01 12:00:00", 2.0),
                            ("A", "2024-01-01 10:00:00", 7.0, "2024-01-01 10:40:00")])
    r = route(rows, DEFAULT, 600)
    v = os.path.join(tmp, "validated_readings")
    T.write_batch(r.validated, v, "validated_readings", 0, "batch")
    out = T.compact(spark, v, "validated_readings", os.path.join(tmp, "compacted"))
    got = {r.time.hour: (r.consumption_kwh, str(r.arrival_ts), str(r.event_date)) for r in out.collect()}
    assert got[10] == (7.0, "2024-01-01 10:40:00", "2024-01-01")
    series = reports.consumption_series(out, ts("2024-01-01 00:00:00"), ts("2024-01-02 00:00:00"))
    assert series.count() == 2


def _append(spark, path, table, batch, rows, run="r"):
    schema = READING if table == "validated_readings" else \
        "time timestamp, metric_type string, meter_id string, value double, tags map<string,string>, seq bigint"
    T.write_batch(spark.createDataFrame([(ts(t), *r, i) for i, (t, *r) in enumerate(rows)], schema), path, table, batch, run)


def _values(df):
    return sorted((r.meter_id, str(r.time)[:10], r.consumption_kwh) for r in df.collect())


def test_a_batch_that_commits_after_a_compaction_is_not_lost(spark, tmp, monkeypatch):
    """It began earlier and was stamped so, but its commit came later; keys still go by the time of the write."""
    v, out = os.path.join(tmp, "log"), os.path.join(tmp, "compacted")
    clock = iter([1000, 2000, 3000])
    monkeypatch.setattr(T.time, "time_ns", lambda: next(clock) * 1000)
    puts = []
    monkeypatch.setattr(T, "put_text", lambda *a: puts.append(a))
    _append(spark, v, "validated_readings", 0, [("2024-01-01 10:00:00", "a", 1.0, "OK"), ("2024-01-02 10:00:00", "k", 1.0, "OK")], "slow")
    monkeypatch.undo()
    clock2 = iter([2000, 3000])
    monkeypatch.setattr(T.time, "time_ns", lambda: next(clock2) * 1000)
    _append(spark, v, "validated_readings", 0, [("2024-01-01 10:00:00", "b", 2.0, "OK"), ("2024-01-02 10:00:00", "k", 2.0, "OK")], "fast")
    assert _values(T.compact(spark, v, "validated_readings", out)) == [("b", "2024-01-01", 2.0), ("k", "2024-01-02", 2.0)]
    T.put_text(*puts[0])  # the slow batch commits now
    want = [("a", "2024-01-01", 1.0), ("b", "2024-01-01", 2.0), ("k", "2024-01-02", 2.0)]
    assert _values(T.read_table(spark, v, "validated_readings", out)) == want
    assert _values(T.read_table(spark, v, "validated_readings")) == want
    assert _values(T.compact(spark, v, "validated_readings", out)) == want
    assert T.uncovered(spark, v, out) == []
    assert _values(T.compact(spark, v, "validated_readings", out)) == want


def test_merge_on_read_does_not_scan_covered_batches(spark, tmp):
    import re
    v, out = os.path.join(tmp, "log"), os.path.join(tmp, "compacted")
    for k in range(4):
        _append(spark, v, "validated_readings", k, [(f"2024-01-0{k + 1} 10:00:00", "m", float(k), "OK"), ("2024-01-09 10:00:00", "m", float(k), "OK")])
    T.compact(spark, v, "validated_readings", out)
    _append(spark, v, "validated_readings", 4, [("2024-01-09 10:00:00", "m", 9.0, "OK"), ("2024-01-10 10:00:00", "m", 5.0, "OK")])
    df = T.read_table(spark, v, "validated_readings", out)
    assert not [f for f in df.inputFiles() if re.search(r"_batch_id=[0-3]/", f)] and [f for f in df.inputFiles() if "_batch_id=4/" in f]
    want = [("m", f"2024-01-0{k + 1}", float(k)) for k in range(4)] + [("m", "2024-01-09", 9.0), ("m", "2024-01-10", 5.0)]
    assert _values(df) == want == _values(T.read_table(spark, v, "validated_readings"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[.*event_date", plan)) >= 2
    before = {f: os.stat(f).st_mtime_ns for d, _, names in os.walk(out) for f in (os.path.join(d, n) for n in names) if "2024-01-0" in d and "01-09" not in d}
    assert _values(T.compact(spark, v, "validated_readings", out)) == want
    assert before and all(os.stat(f).st_mtime_ns == t for f, t in before.items())


def test_compaction_that_died_halfway_repeats_no_row(spark, tmp, monkeypatch):
    """Days are replaced, but the cover is not written: the next one starts over from the same batches."""
    import pytest
    v, out = os.path.join(tmp, "metrics"), os.path.join(tmp, "compacted")
    rows = [("2024-01-01 10:00:00", "x", "m", 1.0, {}), ("2024-01-01 10:00:00", "x", "m", 1.0, {})]
    _append(spark, v, "metrics", 0, rows)
    T.compact(spark, v, "metrics", out)
    _append(spark, v, "metrics", 1, rows[:1])
    real, calls = T._write_days, []

    def dies(*a, **k):
        real(*a, **k)
        calls.append(1)
        raise RuntimeError("lost")
    monkeypatch.setattr(T, "_write_days", dies)
    with pytest.raises(RuntimeError):
        T.compact(spark, v, "metrics", out)
    monkeypatch.undo()
    assert calls and T.compact(spark, v, "metrics", out).count() == 3 == T.read_table(spark, v, "metrics").count()
    T.write_batch(spark.createDataFrame([(ts("2024-01-01 10:00:00"), "x", "m", 1.0, {}, 0)], "time timestamp, metric_type string, "
                  "meter_id string, value double, tags map<string,string>, seq bigint"), v, "metrics", 1, "r")  # a retry
    assert T.compact(spark, v, "metrics", out).count() == 3


def test_rows_without_a_time_are_merged(spark, tmp):
    v, out = os.path.join(tmp, "log"), os.path.join(tmp, "compacted")
    for k in range(2):
        T.write_batch(spark.createDataFrame([(None, "m", float(k), "OK", 0), (ts("2024-01-01 10:00:00"), "m", float(k), "OK", 1)], READING),
                      v, "validated_readings", k)
        got = T.read_table(spark, v, "validated_readings", out)
        assert sorted((str(r.time), r.consumption_kwh) for r in got.collect()) == [("2024-01-01 10:00:00", float(k)), ("None", float(k))]
        T.compact(spark, v, "validated_readings", out)
