"""Synthetic series and fault injection as Spark jobs.

Randomness is a hash of (seed, salt, key) (``functions.hashing``), for faults the
key being (meter, time), so that re-runs, the stream and the SQL oracle agree.

Fixed values of the reference's generator and replay (defaults):
  meters 10, days 7, interval 30 minutes, ids 'METER_%04d' from 1,
  per-meter base U(0.5, 5.0), per-reading noise U(-0.3, 0.3), clipped at 0,
  rounded to 3 decimals; replay drop probability 0.05, delay probability 0.1,
  largest delay 300 seconds.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsquality.functions.arith import idiv
from tsquality.functions.hashing import below, digits, with_uniforms
from tsquality.functions.time import iso_format
from tsquality.schemas import TOPICS


def generate_readings(spark: SparkSession, start: dt.datetime, num_meters: int = 10, days: int = 7,
                      interval_minutes: int = 30, seed: int = 42) -> DataFrame:
    """G1: ``num_meters`` regular series of ``days*24*60/interval`` readings from ``start``.

    One ``range`` over meters x steps (no join); Spark splits it into tasks.
    """
    n = int(days * 24 * 60 / interval_minutes)
    grid = spark.range(0, num_meters * n).select((F.col("id") / F.lit(n)).cast("bigint").alias("_q"),
                                                 F.col("id"))
    grid = grid.select((F.col("_q") + F.lit(1)).alias("m"), (F.col("id") - F.col("_q") * F.lit(n)).alias("k"))
    return regular_series(grid, F.lit(start).cast("timestamp"), interval_minutes, seed)


def replay_order(readings: DataFrame) -> DataFrame:
    """O1: readings in time order for a replay (parsed time, not text order)."""
    return readings.orderBy("timestamp", "seq")


def regular_series(grid: DataFrame, start, interval_minutes: int, seed: int) -> DataFrame:
    """Readings for a (m BIGINT, k BIGINT) grid: meter m, step k from ``start``."""
    grid = with_uniforms(grid, seed, {"_u_base": ("base", "m"),
                                      "_u_noise": ("noise", F.col("m") * F.lit(1 << 32) + F.col("k"))})
    base = 0.5 + F.col("_u_base") * 4.5
    noise = -0.3 + F.col("_u_noise") * 0.6
    return grid.select(
        F.format_string("METER_%04d", F.col("m")).alias("meter_id"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.col("k") * interval_minutes)).alias("timestamp"),
        F.round(F.greatest(F.lit(0.0), base + noise), 3).alias("consumption_kwh"),
        (F.col("m") * F.lit(1 << 32) + F.col("k")).alias("seq"),
    )


def sample_like(readings: DataFrame, interval_minutes: int = 30, seed: int = 42) -> DataFrame:
    """G1 shaped by a given table: one regular series per meter of ``readings``,
    covering that meter's own first to last day, at ``interval_minutes``.

    The grid is generated per meter by ``sequence`` + ``explode`` on the
    executors (one row per meter goes in, its series comes out), so the work is
    spread by meter and nothing passes through the driver.
    """
    per = (readings.groupBy("meter_id")
           .agg(F.date_trunc("day", F.min("timestamp")).alias("d0"),
                F.date_trunc("day", F.max("timestamp")).alias("d1")))
    n = idiv(idiv(F.unix_micros("d1") - F.unix_micros("d0"), F.lit(60_000_000)) + F.lit(24 * 60),
             F.lit(interval_minutes))
    m = F.regexp_extract("meter_id", r"(\d+)$", 1).cast("bigint")
    grid = per.select(m.alias("m"), "d0", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                               n - 1)).alias("k"))
    return regular_series(grid, F.col("d0"), interval_minutes, seed)


#: A repeated reading's ``seq``: that of the first, and this.
REPEAT_SEQ = 1 << 40

#: What can be wrong with a payload (fixed values, each as likely as the others).
PAYLOAD_FAULTS = ("empty_id", "no_meter", "no_time", "bad_time", "no_kwh", "bad_kwh", "malformed")


def reading_key():
    """The key of a reading's draws: its meter and time, so that file splits and orders do not matter."""
    return F.concat_ws(":", F.col("meter_id"), F.unix_micros("timestamp").cast("string"))


READING_KEY_SQL = "(meter_id || ':' || CAST(epoch_us(timestamp) AS VARCHAR))"


def inject_faults(readings: DataFrame, seed: int = 42, gap_probability: float = 0.05,
                  delay_probability: float = 0.1, max_delay_seconds: int = 300,
                  corrupt_probability: float = 0.0, repeat_probability: float = 0.0) -> DataFrame:
    """Drop readings (gaps) and delay arrivals (lateness); draws are keyed by (meter, time).

    Adds ``arrival_ts``: the time a reading reaches the pipeline, its event time
    plus an optional delay. Unlike a sleeping replay, the delay is a column, so
    arrival order really changes and runs are replayable.

    Two faults more, 0 by default: ``corrupt_probability`` turns values into
    negative or too-large numbers; ``repeat_probability`` sends a reading again
    one second later with another value, so that table keys meet twice.
    """
    key = reading_key()
    d = with_uniforms(readings.where(~below(digits(seed, "drop", key), gap_probability)), seed, {"_u_amount": ("amount", key)})
    d = d.withColumn("_bad", digits(seed, "corrupt", key))
    delay_us = F.when(below(digits(seed, "delay", key), delay_probability),
                      (F.col("_u_amount") * F.lit(max_delay_seconds * 1_000_000)).cast("bigint")).otherwise(F.lit(0))
    kwh = F.col("consumption_kwh")
    kwh = (F.when(below(F.col("_bad"), corrupt_probability / 2), -kwh - F.lit(0.001))
           .when(below(F.col("_bad"), corrupt_probability), kwh * F.lit(1e6) + F.lit(100000.5))
           .otherwise(kwh))
    again = below(digits(seed, "repeat", key), repeat_probability)
    copies = F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    d = (d.withColumn("consumption_kwh", kwh)
         .withColumn("arrival_ts", F.timestamp_micros(F.unix_micros("timestamp") + delay_us)))
    if repeat_probability > 0:
        d = d.withColumn("_copy", F.explode(copies))
        d = (d.withColumn("consumption_kwh", F.col("consumption_kwh") + F.col("_copy") * F.lit(0.5))
             .withColumn("seq", F.col("seq") + F.col("_copy") * F.lit(REPEAT_SEQ))
             .withColumn("arrival_ts", F.timestamp_micros(F.unix_micros("arrival_ts") + F.col("_copy") * F.lit(1_000_000)))
             .drop("_copy"))
    return d.drop("_u_amount", "_bad")


def inject_faults_sql(src: str, seed: int = 42, gap_probability: float = 0.05,
                      delay_probability: float = 0.1, max_delay_seconds: int = 300,
                      corrupt_probability: float = 0.0, repeat_probability: float = 0.0) -> str:
    """DuckDB twin of :func:`inject_faults` over a relation with the reading columns."""
    from tsquality.functions.hashing import uniform01_sql
    half = corrupt_probability / 2

    def u(salt):
        return uniform01_sql(seed, salt, READING_KEY_SQL)
    return f"""
    SELECT meter_id, timestamp, _kwh + _copy * 0.5 AS consumption_kwh, seq + _copy * {REPEAT_SEQ} AS seq,
      make_timestamp(_arrival_us + _copy * 1000000) AS arrival_ts
    FROM (SELECT *,
        CASE WHEN {u('corrupt')} < {half} THEN -consumption_kwh - 0.001
             WHEN {u('corrupt')} < {corrupt_probability} THEN consumption_kwh * 1e6 + 100000.5
             ELSE consumption_kwh END AS _kwh,
        epoch_us(timestamp) + CASE WHEN {u('delay')} < {delay_probability}
             THEN CAST(trunc({u('amount')} * {max_delay_seconds * 1_000_000}) AS BIGINT) ELSE 0 END AS _arrival_us,
        {u('repeat')} AS _u_again
      FROM ({src}) src WHERE {u('drop')} >= {gap_probability}) f,
      (SELECT unnest([0, 1]) AS _copy) c
    WHERE _copy = 0 OR _u_again < {repeat_probability}"""


def faulty_messages(readings: DataFrame, seed: int = 42, probability: float = 0.0) -> DataFrame:
    """Raw-topic messages of ``readings`` (key, value, topic, seq, arrival_ts), of which about
    ``probability`` have one of :data:`PAYLOAD_FAULTS`."""
    d = with_uniforms(readings, seed, {"_kind": ("payload_kind", reading_key())})
    kinds = F.array(*map(F.lit, PAYLOAD_FAULTS))
    kind = F.when(below(digits(seed, "payload", reading_key()), probability),
                  F.element_at(kinds, (F.floor(F.col("_kind") * len(PAYLOAD_FAULTS)) + 1).cast("int")))
    d = d.withColumn("_kind", F.coalesce(kind, F.lit("")))
    kind = F.col("_kind")
    meter = F.when(kind == "empty_id", "").when(kind != "no_meter", F.col("meter_id"))
    time = F.when(kind == "bad_time", "yesterday").when(kind != "no_time", iso_format(F.col("timestamp")))
    fields = [meter.alias("meter_id"), time.alias("timestamp")]
    value = F.to_json(F.struct(*fields, F.when(kind != "no_kwh", F.col("consumption_kwh")).alias("consumption_kwh")))
    value = F.when(kind == "bad_kwh", F.to_json(F.struct(*fields, F.lit("n/a").alias("consumption_kwh")))) \
        .when(kind == "malformed", F.substring(value, F.lit(1), F.length(value) - 1)) \
        .otherwise(value)
    return d.select(F.col("meter_id").alias("key"), value.alias("value"), F.lit(TOPICS["raw"]).alias("topic"), "seq",
                    "arrival_ts")


def faulty_messages_sql(src: str, seed: int = 42, probability: float = 0.0) -> str:
    """What the payloads of :func:`faulty_messages` hold once parsed, with the fault as ``kind``."""
    from tsquality.functions.hashing import uniform01_sql
    kinds = ", ".join(f"'{k}'" for k in PAYLOAD_FAULTS)
    u, which = (uniform01_sql(seed, salt, READING_KEY_SQL) for salt in ("payload", "payload_kind"))
    return f"""
    SELECT CASE WHEN kind = 'empty_id' THEN '' WHEN kind NOT IN ('no_meter', 'malformed') THEN meter_id END AS meter_id,
      CASE WHEN kind NOT IN ('no_time', 'bad_time', 'malformed') THEN timestamp END AS timestamp,
      CASE WHEN kind NOT IN ('no_kwh', 'bad_kwh', 'malformed') THEN consumption_kwh END AS consumption_kwh,
      seq, arrival_ts, kind
    FROM (SELECT *, CASE WHEN {u} < {probability}
            THEN [{kinds}][CAST(floor({which} * {len(PAYLOAD_FAULTS)}) AS INTEGER) + 1] ELSE '' END AS kind
          FROM ({src}) f) k"""
