"""Adapter from the driver's ``events`` table to readings.

``events`` is the only time series among the given tables:
``meter_id = format_string('METER_%04d', user_id)``, ``timestamp = ts`` (the
file holds TIMESTAMP_NTZ, read as UTC), ``consumption_kwh = value``,
``seq = event_id`` (arrival order of the source).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsquality.session import prepare

TABLES = ("events",)
#: Rows of ``events`` that one task draws faults for, renders and parses.
ROWS_PER_TASK = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def readings_from_events(events: DataFrame) -> DataFrame:
    """meter_id STRING, timestamp TIMESTAMP, consumption_kwh DOUBLE, seq BIGINT."""
    return events.select(
        F.format_string("METER_%04d", F.col("user_id")).alias("meter_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").cast("double").alias("consumption_kwh"),
        F.col("event_id").alias("seq"),
    )


def dealt(events: DataFrame) -> DataFrame:
    """``events`` over as many tasks as its rows need: they take few bytes and much work, and a file of a single
    row group is otherwise read, and worked on, by one task. Where there are files enough, it stays as it is."""
    tasks = -(-events.count() // ROWS_PER_TASK)  # from the files' footers
    if len(events.inputFiles()) >= tasks:
        return events
    return events.repartition(tasks, "event_id", "user_id", "ts")


def load_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return readings_from_events(dealt(read_table(spark, sf_dir, "events")))


# DuckDB form of the adapter, shared by every oracle query.
READINGS_SQL = (
    "SELECT printf('METER_%04d', user_id) AS meter_id, CAST(ts AS TIMESTAMP) AS timestamp, "
    "CAST(value AS DOUBLE) AS consumption_kwh, event_id AS seq FROM events"
)
