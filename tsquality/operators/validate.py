"""Validation and quarantine.

Validator messages (fixed values, in the order they are tested):
  Missing required field: meter_id
  Missing required field: timestamp
  Missing required field: consumption_kwh
  Invalid meter_id
  Invalid timestamp type
  Invalid consumption_kwh value
  Consumption cannot be negative
  Consumption value too large
  OK
0 and the upper bound itself are valid. NaN is rejected as an invalid value
(SURVEY D11); it is tested before the upper bound because NaN > x is true in Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsquality.config import DEFAULT, QualityConfig

OK = "OK"


def validation_result(cfg: QualityConfig = DEFAULT, meter_id: str = "meter_id", ts: str = "timestamp",
                      kwh: str = "consumption_kwh", ts_text: str | None = None,
                      kwh_text: str | None = None) -> Column:
    """One CASE column with the validator's verdict.

    With ``ts_text`` / ``kwh_text`` (raw message fields) a present-but-unparsable
    value is told apart from a missing one; for typed input NULL means missing.
    """
    mid, t, v = F.col(meter_id), F.col(ts), F.col(kwh)
    ts_missing = F.col(ts_text).isNull() if ts_text else t.isNull()
    kwh_missing = F.col(kwh_text).isNull() if kwh_text else v.isNull()
    return (F.when(mid.isNull(), F.lit("Missing required field: meter_id"))
            .when(ts_missing, F.lit("Missing required field: timestamp"))
            .when(kwh_missing, F.lit("Missing required field: consumption_kwh"))
            .when(mid == F.lit(""), F.lit("Invalid meter_id"))
            .when(t.isNull(), F.lit("Invalid timestamp type"))
            .when(v.isNull() | F.isnan(v), F.lit("Invalid consumption_kwh value"))
            .when(v < F.lit(0.0), F.lit("Consumption cannot be negative"))
            .when(v > F.lit(cfg.max_kwh), F.lit("Consumption value too large"))
            .otherwise(F.lit(OK)))


def validate(df: DataFrame, cfg: QualityConfig = DEFAULT, **cols) -> DataFrame:
    """Add ``validation`` (the message) and ``error`` (NULL when valid)."""
    res = validation_result(cfg, **cols)
    d = df.select("*", res.alias("validation"))
    return d.select("*", F.when(F.col("validation") != F.lit(OK), F.col("validation")).alias("error"))


def quarantine_metrics(validated: DataFrame) -> DataFrame:
    """One ``invalid_event`` metric (value 1.0, tags {error}) per invalid row; payloads that
    were not even JSON are ``processing_error`` metrics elsewhere."""
    if "parse_error" in validated.columns:
        validated = validated.where(F.col("parse_error").isNull())
    return (validated.where(F.col("error").isNotNull())
            .select(F.lit("invalid_event").alias("metric_type"), "meter_id",
                    F.lit(1.0).alias("value"),
                    F.create_map(F.lit("error"), F.col("error")).alias("tags"),
                    *[c for c in ("seq", "arrival_ts", "_bucket") if c in validated.columns]))
