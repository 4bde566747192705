"""Topics that the examples fill are written by as many tasks as their rows need, in the same micro-batches."""

import datetime as dt
import glob

from tsquality.plans import catalog
from tsquality.session import settings
from tsquality.sources.synth import REPEAT_SEQ


def _events(spark, path):
    base = dt.datetime(2024, 1, 1)
    rows = [(k, base + dt.timedelta(hours=2 * k), k % 5, float(k % 9)) for k in range(300)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, value double").repartition(4) \
        .write.parquet(f"{path}/events.parquet")
    return path


def _bases(monkeypatch):
    seen, scratch = {}, catalog.scratch_path

    def noted(spark, name):
        seen[name] = scratch(spark, name)
        return seen[name]
    monkeypatch.setattr(catalog, "scratch_path", noted)
    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 40, raising=False)
    return seen


def _most(spark, files):
    return max(spark.read.parquet(f).count() for f in files)


def test_counted_messages_have_files_of_some_rows_and_a_batch_a_part(spark, tmp, monkeypatch):
    sf, seen = _events(spark, tmp), _bases(monkeypatch)
    got = {(r.metric_type, r.batch): r.value for r in catalog.q_stream_batch_counts(spark, sf).collect()}
    files = glob.glob(seen["counts"].removeprefix("file:") + "/messages/chunk=*/part-*")
    assert len(files) > 3 and _most(spark, files) < 90
    sent = catalog.faulted(spark, sf).selectExpr("seq % 3 AS k").groupBy("k").count().collect()
    assert REPEAT_SEQ > 300 and {k: got[("validation_rows", k)] for k in range(3)} == {r["k"]: r["count"] for r in sent}


def test_consumed_messages_have_files_of_some_rows_and_count_once(spark, tmp, monkeypatch):
    sf, seen = _events(spark, tmp), _bases(monkeypatch)
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.openCostInBytes": "1",
                          "spark.sql.files.maxPartitionBytes": "4096"}):
        got = catalog.q_consume_results(spark, sf).groupBy("route").count().collect()
    files = glob.glob(seen["consume"].removeprefix("file:") + "/topics/chunk=*/part-*")
    r = catalog.routes(spark, sf)
    assert {x["route"]: x["count"] for x in got}["metrics"] == r.metrics.count()
    assert len(files) > 2 and _most(spark, files) < r.metrics.count()
