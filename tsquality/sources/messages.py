"""JSON payloads and the Kafka edges.

The connector jar and a broker are not available offline, so the Kafka
functions only wrap ``spark.read/readStream/write.format("kafka")`` around the
payload transforms ``parse_readings`` / ``to_messages`` / ``parse_results``,
which are tested on files with the same ``(key, value, topic)`` columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsquality.config import DEFAULT, QualityConfig
from tsquality.functions.numeric import parse_float
from tsquality.functions.time import iso_format, parse_iso_timestamp
from tsquality.operators.validate import validate
from tsquality.schemas import PAYLOAD_TEXT, RESULT_SCHEMAS, TOPICS

PARSE_ERROR = "malformed JSON payload"


def parse_readings(messages: DataFrame, cfg: QualityConfig = DEFAULT, value: str = "value") -> DataFrame:
    """P1 + P3 + P4: payload text -> typed reading, ``validation`` / ``error`` and
    ``parse_error`` (non-JSON or not an object; such rows get meter ``NULL``).

    Other columns of ``messages`` (offsets, arrival time, ...) are kept.
    """
    j = F.from_json(F.col(value), PAYLOAD_TEXT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    d = messages.withColumn("_j", j)
    bad = F.col("_j").isNull() | F.col("_j._corrupt").isNotNull()
    d = (d.withColumn("parse_error", F.when(bad, F.lit(PARSE_ERROR)))
         .withColumn("meter_id", F.when(~bad, F.col("_j.meter_id")))
         .withColumn("_ts_text", F.when(~bad, F.col("_j.timestamp")))
         .withColumn("_kwh_text", F.when(~bad, F.col("_j.consumption_kwh")))
         .withColumn("timestamp", parse_iso_timestamp(F.col("_ts_text")))
         .withColumn("consumption_kwh", parse_float(F.col("_kwh_text"))))
    d = validate(d, cfg, ts_text="_ts_text", kwh_text="_kwh_text")
    d = d.withColumn("error", F.when(F.col("parse_error").isNotNull(), F.lit("processing_error"))
                     .otherwise(F.col("error")))
    return d.drop("_j", "_ts_text", "_kwh_text")


def reading_payload(meter_id: Column, ts: Column, kwh: Column) -> Column:
    """``{"meter_id", "timestamp" (ISO), "consumption_kwh"}`` as JSON text."""
    return F.to_json(F.struct(meter_id.alias("meter_id"), iso_format(ts).alias("timestamp"),
                              kwh.alias("consumption_kwh")))


def to_messages(readings: DataFrame, topic: str = TOPICS["raw"], keep: tuple[str, ...] = ()) -> DataFrame:
    """key = meter id (keeps a meter on one partition), value = JSON payload."""
    return readings.select(*keep, F.col("meter_id").alias("key"),
                           reading_payload(F.col("meter_id"), F.col("timestamp"), F.col("consumption_kwh")).alias("value"),
                           F.lit(topic).alias("topic"))


def result_messages(routed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """S6 + P6: routed result rows -> (topic, key, value) for the four result topics.

    ``routed`` has ``route`` in {validated, gap_alerts, late_events, metrics} and the
    columns of the matching record.
    """
    def ts(c):
        return iso_format(F.col(c))
    payload = (F.when(F.col("route") == "validated", F.to_json(F.struct(
                   F.col("meter_id"), ts("timestamp").alias("timestamp"), F.col("consumption_kwh"), F.col("status"))))
               .when(F.col("route") == "gap_alerts", F.to_json(F.struct(
                   F.col("meter_id"), ts("missing_from").alias("missing_from"), ts("missing_to").alias("missing_to"),
                   F.col("gap_minutes"))))
               .when(F.col("route") == "late_events", F.to_json(F.struct(
                   F.col("meter_id"), ts("timestamp").alias("timestamp"), F.col("consumption_kwh"),
                   F.col("delay_seconds"))))
               .otherwise(F.to_json(F.struct(
                   F.col("metric_type"), F.col("meter_id"), ts("timestamp").alias("timestamp"), F.col("value"),
                   F.coalesce(F.col("tags"), F.create_map().cast("map<string,string>")).alias("tags")))))
    topic = F.element_at(F.create_map(*[x for k, v in TOPICS.items() if k != "raw"
                                        for x in (F.lit(k), F.lit(v))]), F.col("route"))
    return routed.select(topic.alias("topic"), F.col("meter_id").alias("key"), payload.alias("value"), *keep)


def parse_results(messages: DataFrame, route: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """A result topic's JSON back to typed columns (ISO text to TIMESTAMP)."""
    schema = RESULT_SCHEMAS[route]
    text = ", ".join(f"{f.name} {'STRING' if f.dataType.typeName() == 'timestamp' else f.dataType.simpleString()}"
                     for f in schema.fields)
    keep = tuple(c for c in keep if c in messages.columns)
    d = messages.select(*keep, F.from_json(F.col("value"), text).alias("_r")).select(*keep, "_r.*")
    for f in schema.fields:
        if f.dataType.typeName() == "timestamp":
            d = d.withColumn(f.name, parse_iso_timestamp(F.col(f.name)))
    return d


# -- Kafka edges (connector jar required at run time) -------------------------

def kafka_source(spark: SparkSession, servers: str, topic: str = TOPICS["raw"], stream: bool = True,
                 group: str = "tsquality", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Subscribe from the earliest offsets; ``value``/``key`` as text.

    ``max_offsets_per_trigger`` cuts micro-batches, and so moves the watermark at other
    moments: lateness and timers depend on it. It is off unless asked for.
    """
    reader = spark.readStream if stream else spark.read
    reader = (reader.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
              .option("startingOffsets", "earliest").option("kafka.group.id", group))
    if stream and max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return (reader.load()
            .select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition", "offset",
                    F.col("timestamp").alias("arrival_ts")))


def kafka_write(messages: DataFrame, servers: str) -> None:
    """S5 / S6 batch write: ``topic`` column picks the topic; acks=all, idempotent, snappy."""
    (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("kafka.acks", "all").option("kafka.enable.idempotence", "true")
     .option("kafka.compression.type", "snappy").save())
