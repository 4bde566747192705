import datetime as dt

from pyspark.sql import functions as F


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def readings(spark, rows, arrival=None):
    """rows: (meter_id, 'YYYY-mm-dd HH:MM[:SS[.f]]', kwh[, arrival text])."""
    out = []
    for i, r in enumerate(rows):
        arr = r[3] if len(r) > 3 else r[1]
        out.append((r[0], ts(r[1]) if r[1] else None, r[2], i, ts(arr) if arr else None))
    return spark.createDataFrame(out, "meter_id string, timestamp timestamp, consumption_kwh double, "
                                      "seq bigint, arrival_ts timestamp")


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
