"""Observed counts of a stream's micro-batches in the metrics table."""

import json

from pyspark.sql import functions as F

from tsquality.config import DEFAULT
from tsquality.operators import tables as T
from tsquality.sources.replay import write_after
from tsquality.streaming import job
from tsquality.streaming.counts import counted, observe_errors


def _messages(spark, values, first):
    rows = [("m", v, first + k) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "key string, value string, offset bigint").withColumn(
        "arrival_ts", F.timestamp_seconds(F.lit(1704067200) + F.col("offset"))).coalesce(1)


def test_counts_of_the_stateful_stream(spark, tmp):
    """Rows pass two branches of the job's plan and are counted once; a resumed query adds its own batches."""
    def good(k):
        return json.dumps({"meter_id": "m", "timestamp": f"2024-01-01T0{k}:00:00", "consumption_kwh": 1.0})
    bad = json.dumps({"meter_id": "m", "timestamp": "2024-01-01T00:00:00", "consumption_kwh": -1.0})
    batches = [[good(0), bad, "no json"], [good(1), good(2)], [bad, "{", "no json", good(3)]]

    def run():
        counts = counted(spark, f"{tmp}/out")
        stream = observe_errors(job.message_readings(spark, f"{tmp}/in", "parquet", files_per_trigger=1))
        job.start(stream, f"{tmp}/out", f"{tmp}/checkpoint", DEFAULT, state_partitions=2, query_name=counts.query_name).awaitTermination()
        counts.wait()
        metrics = T.read_table(spark, f"{tmp}/out/metrics", "metrics").where(F.col("metric_type").startswith("validation_"))
        return sorted((r.tags["batch"], r.metric_type, r.value) for r in metrics.collect())
    newest = 0
    for k, values in enumerate(batches[:2]):
        newest = write_after(_messages(spark, values, 10 * k), f"{tmp}/in/chunk={k}", newest)
    first = [("0", "validation_invalid", 2.0), ("0", "validation_rows", 3.0), ("0", "validation_unparsed", 1.0),
             ("1", "validation_invalid", 0.0), ("1", "validation_rows", 2.0), ("1", "validation_unparsed", 0.0)]
    assert [r for r in run() if r[0] in "01"] == first
    write_after(_messages(spark, batches[2], 20), f"{tmp}/in/chunk=2", newest)
    got = run()
    assert [r for r in got if r[0] in "01"] == first
    assert sorted(v for b, _, v in got if b not in "01") == [2.0, 3.0, 4.0]
    # The job's own metrics stand beside them.
    own = T.read_table(spark, f"{tmp}/out/metrics", "metrics").where("metric_type = 'processing_error'")
    assert own.count() == 3
