"""The result tables and their table function in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """The result tables as views of their names, and ``get_active_meters(hours_back, at)`` over
    ``validated_readings``: of each meter with a reading in the last ``hours_back`` hours (24) before ``at`` (now),
    the last reading and how many. Both last as long as the session; a second call replaces them."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    dated = "event_date" in tables["validated_readings"].columns
    days = "AND event_date >= to_date(at - make_dt_interval(0, hours_back))" if dated else ""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION get_active_meters(hours_back INT DEFAULT 24, at TIMESTAMP DEFAULT current_timestamp())
        RETURNS TABLE (meter_id STRING, last_seen TIMESTAMP, reading_count BIGINT)
        RETURN SELECT meter_id, max(time), count(*) FROM validated_readings
          WHERE time >= at - make_dt_interval(0, hours_back) {days} GROUP BY meter_id""")
