"""JSON messages through the stream, and the result-topic payloads."""

import json
import os

from pyspark.sql import functions as F

from tsquality.config import DEFAULT
from tsquality.sources.messages import parse_results, result_messages, to_messages
from tsquality.streaming import job

from helpers import readings


def test_message_stream(spark, tmp):
    src = os.path.join(tmp, "raw")
    os.makedirs(src)
    msgs = [
        {"key": "M1", "value": json.dumps({"meter_id": "M1", "timestamp": "2024-01-01T10:00:00Z",
                                           "consumption_kwh": 1.5}), "offset": 0},
        {"key": "M1", "value": "not JSON", "offset": 1},
        {"key": "M2", "value": json.dumps({"meter_id": "M2", "timestamp": "2024-01-01T10:05:00Z",
                                           "consumption_kwh": -1}), "offset": 2},
        {"key": "M1", "value": json.dumps({"meter_id": "M1", "timestamp": "2024-01-01T12:00:00Z",
                                           "consumption_kwh": "2"}), "offset": 3},
    ]
    for i, m in enumerate(msgs):
        p = os.path.join(src, f"m{i}.json")
        with open(p, "w") as f:
            f.write(json.dumps(dict(m, arrival_ts=f"2024-01-01T1{i}:00:00Z")) + "\n")
        os.utime(p, (1_600_000_000 + i, 1_600_000_000 + i))
    q = job.start(job.message_readings(spark, src, files_per_trigger=1), os.path.join(tmp, "out"), os.path.join(tmp, "ckpt"), DEFAULT)
    q.awaitTermination()
    t = job.read_tables(spark, os.path.join(tmp, "out"))
    assert sorted((r.meter_id, r.consumption_kwh) for r in t["validated_readings"].collect()) == [("M1", 1.5), ("M1", 2.0)]
    m = {(r.metric_type, r.meter_id, r.tags.get("error")) for r in t["metrics"].collect()}
    assert ("processing_error", "unknown", "malformed JSON payload") in m
    assert ("invalid_event", "M2", "Consumption cannot be negative") in m
    gaps = t["gap_alerts"].collect()
    assert [(g.missing_from.strftime("%H:%M"), g.gap_minutes) for g in gaps if g.detected_by == "event"] == [("10:30", 90)]


def test_payload_round_trip(spark):
    r = readings(spark, [("M1", "2024-01-01 10:00:00.250000", 1.5), ("M2", "2024-01-01 11:00:00", 0.0)])
    back = to_messages(r).select(F.from_json("value", "meter_id string, timestamp string, consumption_kwh double")
                                 .alias("j")).select("j.*").collect()
    assert sorted((x.meter_id, x.timestamp, x.consumption_kwh) for x in back) == \
        [("M1", "2024-01-01T10:00:00.250000+00:00", 1.5), ("M2", "2024-01-01T11:00:00+00:00", 0.0)]
    routed = r.select(F.lit("validated").alias("route"), "meter_id", "timestamp", "consumption_kwh",
                      F.lit("OK").alias("status"))
    for c, t in [("missing_from", "timestamp"), ("missing_to", "timestamp"), ("gap_minutes", "int"),
                 ("delay_seconds", "int"), ("metric_type", "string"), ("value", "double"),
                 ("tags", "map<string,string>")]:
        routed = routed.withColumn(c, F.lit(None).cast(t))
    msgs = result_messages(routed)
    assert {x.topic for x in msgs.collect()} == {"smartmeter_validated"}
    parsed = parse_results(msgs, "validated").collect()
    assert sorted((x.meter_id, str(x.timestamp), x.status) for x in parsed) == \
        [("M1", "2024-01-01 10:00:00.250000", "OK"), ("M2", "2024-01-01 11:00:00", "OK")]


def test_consume_result_topics(spark, tmp):
    """S6 -> S7: result messages written to topic stand-in files, consumed into tables."""
    r = readings(spark, [("M1", "2024-01-01 10:00:00", 1.5), ("M1", "2024-01-01 10:00:00", 2.5)])
    routed = r.select(F.lit("validated").alias("route"), "meter_id", "timestamp", "consumption_kwh",
                      F.lit("OK").alias("status"), "seq")
    for c, t in [("missing_from", "timestamp"), ("missing_to", "timestamp"), ("gap_minutes", "int"),
                 ("delay_seconds", "int"), ("metric_type", "string"), ("value", "double"),
                 ("tags", "map<string,string>")]:
        routed = routed.withColumn(c, F.lit(None).cast(t))
    src = os.path.join(tmp, "topics")
    msgs = result_messages(routed).withColumn("offset", F.monotonically_increasing_id())
    msgs.coalesce(1).write.json(src)
    stream = spark.readStream.schema("topic STRING, key STRING, value STRING, offset BIGINT").json(src)
    q = job.consume_results(stream, os.path.join(tmp, "out"), os.path.join(tmp, "ckpt"))
    q.awaitTermination()
    t = job.read_tables(spark, os.path.join(tmp, "out"))
    # Upsert on (time, meter_id): the later offset wins.
    assert [(x.meter_id, x.consumption_kwh) for x in t["validated_readings"].collect()] == [("M1", 2.5)]


def test_processor_output_to_result_topics(spark):
    """From the processor's rows to the four topics and back."""
    from tsquality.streaming.processor import OUTPUT_SCHEMA
    us = 1_704_103_200_000_000  # 2024-01-01 10:00
    rows = [("validated", "M1", 1, us, us, 1.5, "LATE", None, None, None, None, None, None, None),
            ("late", "M1", 2, us, us, 2.5, None, 4000, None, None, None, None, None, None),
            ("gap", "M1", 3, us, us, None, None, None, us, us + 60_000_000, 1, "timer", None, 1),
            ("invalid", None, 4, None, us, None, None, None, None, None, None, None, "Invalid meter_id", None)]
    tables = job.routed_tables(spark.createDataFrame([(*r, 0) for r in rows], OUTPUT_SCHEMA))
    msgs = job.result_topic_messages(tables).cache()
    assert sorted(r.topic for r in msgs.collect()) == ["smartmeter_gap_alerts", "smartmeter_late_events"] + \
        ["smartmeter_metrics"] * 4 + ["smartmeter_validated"]
    by = {t: parse_results(msgs.where(F.col("topic") == f"smartmeter_{t}"), t).collect()
          for t in ("validated", "late_events", "gap_alerts", "metrics")}
    assert [(r.meter_id, str(r.timestamp), r.status) for r in by["validated"]] == [("M1", "2024-01-01 10:00:00", "LATE")]
    assert [(r.delay_seconds, r.consumption_kwh) for r in by["late_events"]] == [(4000, 2.5)]
    assert [(str(r.missing_to), r.gap_minutes) for r in by["gap_alerts"]] == [("2024-01-01 10:01:00", 1)]
    assert sorted(r.metric_type for r in by["metrics"]) == ["event_processed", "gap_detected_timer", "invalid_event", "too_late_event"]


def test_messages_sent_twice_are_consumed_once(spark, tmp):
    """A producer's retry, in the same micro-batch and in a later one; metrics have no key that would hide it."""
    src = os.path.join(tmp, "topics")
    value = '{"metric_type":"x","meter_id":"M","timestamp":"2024-01-01T10:00:00+00:00","value":1.0,"tags":{}}'
    rows = [("smartmeter_metrics", "M", value, k, f"id{k}") for k in range(3)]
    for n, some in enumerate((rows + rows[:1], rows)):
        msgs = spark.createDataFrame(some, "topic string, key string, value string, offset bigint, message_id string")
        msgs.withColumn("sent_ts", F.lit("2024-01-01 10:00:00").cast("timestamp")).coalesce(1).write.mode("append").json(src)
        stream = spark.readStream.schema(f"{job.RESULT_MESSAGE}").json(src)
        job.consume_results(stream, os.path.join(tmp, "out"), os.path.join(tmp, "ckpt"), once_within="1 hour").awaitTermination()
    assert job.read_tables(spark, os.path.join(tmp, "out"))["metrics"].count() == 3
