"""Record and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# A reading as it enters the flow (typed), with its source order and arrival time.
READING = T.StructType([
    T.StructField("meter_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("consumption_kwh", T.DoubleType()),
    T.StructField("seq", T.LongType()),
    T.StructField("arrival_ts", T.TimestampType()),
])

# JSON payload fields read as text, so numbers and strings both arrive verbatim.
PAYLOAD_TEXT = T.StructType([
    T.StructField("meter_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("consumption_kwh", T.StringType()),
    T.StructField("_corrupt", T.StringType()),
])

# Kafka-shaped records (also used for file stand-ins of a topic).
MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

VALIDATED = T.StructType([
    T.StructField("meter_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("consumption_kwh", T.DoubleType()),
    T.StructField("status", T.StringType()),
])
GAP_ALERT = T.StructType([
    T.StructField("meter_id", T.StringType()),
    T.StructField("missing_from", T.TimestampType()),
    T.StructField("missing_to", T.TimestampType()),
    T.StructField("gap_minutes", T.IntegerType()),
])
LATE_EVENT = T.StructType([
    T.StructField("meter_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("consumption_kwh", T.DoubleType()),
    T.StructField("delay_seconds", T.IntegerType()),
])
METRIC = T.StructType([
    T.StructField("metric_type", T.StringType()),
    T.StructField("meter_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])
RESULT_SCHEMAS = {"validated": VALIDATED, "gap_alerts": GAP_ALERT, "late_events": LATE_EVENT, "metrics": METRIC}

# Topic names (fixed values of the reference's configuration).
TOPICS = {
    "raw": "smartmeter_raw",
    "validated": "smartmeter_validated",
    "gap_alerts": "smartmeter_gap_alerts",
    "late_events": "smartmeter_late_events",
    "metrics": "smartmeter_metrics",
}
