"""Result tables with the reference's key-conflict rules.

There is no table format with MERGE here, so a table is an append log of
micro-batches, each written to ``<table>/_run_id=R/_batch_id=N/`` in overwrite
mode: a retried batch replaces its own output (effectively-once), and a run with
a new checkpoint, which counts its batches from 0 again, touches no other run's.
Writes are ordered by the time of the write (``_written``), the batch and, in a
batch, ``_wseq``. Keys are resolved on read, by an aggregation (partial on the
map side, so a key with many copies is collapsed before the shuffle and never
lands whole in one task):

* ``validated_readings`` key (time, meter_id): the latest write wins (upsert);
* ``gap_alerts`` key (time, meter_id, missing_from): the first write wins;
* ``late_events`` key (time, meter_id, event_timestamp): the first write wins;
* ``metrics``: append only, no key (SURVEY D14).

Within a batch, writes are ordered by ``seq`` (and, for alerts, a timer before
an event alert: SURVEY D16). Tables are partitioned by ``event_date``.

A batch counts once it is committed: its last write is an entry of the commit log,
``<table>/_commits/``, with its days. ``compact`` keeps a copy by day with one row a
key and, in it, the order of the write that won. It takes the entries that it has not
covered yet, whenever they began and whatever their clock says, resolves them with
the copy's rows of their days, and replaces these days alone. ``read_table`` with
that copy merges on read: the days of uncovered entries are resolved with these, the
others are read as they are, and covered batches not at all.
"""

from __future__ import annotations

import json
import time
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from tsquality.session import folder_names, materialize, path_exists, put_text

KEYS = {
    "validated_readings": ["time", "meter_id"],
    "gap_alerts": ["time", "meter_id", "missing_from"],
    "late_events": ["time", "meter_id", "event_timestamp"],
    "metrics": None,
}
RULE = {"validated_readings": "latest", "gap_alerts": "first", "late_events": "first", "metrics": "append"}
COLUMNS = {
    "validated_readings": ["time", "meter_id", "consumption_kwh", "status"],
    "gap_alerts": ["time", "meter_id", "missing_from", "missing_to", "gap_minutes"],
    "late_events": ["time", "meter_id", "event_timestamp", "consumption_kwh", "delay_seconds"],
    "metrics": ["time", "metric_type", "meter_id", "value", "tags"],
}


_TYPES = {
    "validated_readings": "time TIMESTAMP, meter_id STRING, consumption_kwh DOUBLE, status STRING",
    "gap_alerts": "time TIMESTAMP, meter_id STRING, missing_from TIMESTAMP, missing_to TIMESTAMP, "
                  "gap_minutes INT, detected_by STRING",
    "late_events": "time TIMESTAMP, meter_id STRING, event_timestamp TIMESTAMP, consumption_kwh DOUBLE, "
                   "delay_seconds INT",
    "metrics": "time TIMESTAMP, metric_type STRING, meter_id STRING, value DOUBLE, tags MAP<STRING, STRING>",
}


def log_schema(table: str) -> str:
    """Schema of a table log, partition columns included (an empty log reads as empty)."""
    return (_TYPES[table] + ", arrival_ts TIMESTAMP, _wseq STRUCT<b: BIGINT, k: INT, s: BIGINT>, _written BIGINT, "
            "_run_id STRING, _batch_id BIGINT, event_date DATE")


def write_order(df: DataFrame, table: str) -> DataFrame:
    """``_wseq``: order of the writes inside a batch (of a routed batch run: by arrival bucket first)."""
    bucket = F.col("_bucket") if "_bucket" in df.columns else F.lit(0)
    kind = F.lit(0)
    if table == "gap_alerts" and "detected_by" in df.columns:
        kind = F.when(F.col("detected_by") == F.lit("timer"), F.lit(0)).otherwise(F.lit(1))
    return df.withColumn("_wseq", F.struct(bucket.cast("bigint").alias("b"), kind.alias("k"), F.col("seq").alias("s")))


def write_batch(df: DataFrame, path: str, table: str, batch_id: int, run_id: str = "0") -> None:
    """Write one micro-batch of ``table`` (idempotent per ``run_id`` and ``batch_id``), then commit it."""
    spark, began = df.sparkSession, time.time_ns() // 1000
    extra = [c for c in ("detected_by", "arrival_ts") if c in df.columns]
    out = (write_order(df, table)
           .select(*COLUMNS[table], *extra, "_wseq", F.lit(began).alias("_written"), F.to_date("time").alias("event_date")))
    folder = f"{path}/_run_id={run_id}/_batch_id={int(batch_id)}"
    out.write.mode("overwrite").partitionBy("event_date").parquet(folder)
    days = [unquote(n.partition("=")[2]) for n in folder_names(spark, folder) if n.startswith("event_date=")]
    entry = {"run_id": run_id, "batch_id": int(batch_id), "attempt": uuid.uuid4().hex, "days": sorted(days)}
    put_text(spark, f"{path}/_commits/{run_id}-{int(batch_id)}.json", json.dumps(entry) + "\n")


ENTRY = "run_id STRING, batch_id BIGINT, attempt STRING"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The commit log: run_id, batch_id, attempt (another one if a batch was written again), days."""
    if not path_exists(spark, f"{path}/_commits"):
        return spark.createDataFrame([], f"{ENTRY}, days ARRAY<STRING>")
    return spark.read.schema(f"{ENTRY}, days ARRAY<STRING>").json(f"{path}/_commits")


def uncovered(spark: SparkSession, path: str, out_path: str) -> list:
    """The entries that the compacted copy does not cover (a row a batch)."""
    log = commits(spark, path)
    if path_exists(spark, f"{out_path}.covered"):
        done = spark.read.schema(ENTRY).json(f"{out_path}.covered")
        log = log.join(done, ["run_id", "batch_id", "attempt"], "left_anti")
    return log.collect()


def read_batches(spark: SparkSession, path: str, table: str, entries: list) -> DataFrame:
    """The rows of committed batches, read from their own folders alone."""
    if not entries:
        return spark.createDataFrame([], log_schema(table))
    folders = [f"{path}/_run_id={e['run_id']}/_batch_id={e['batch_id']}" for e in entries if e["days"]]
    if not folders:
        return spark.createDataFrame([], log_schema(table))
    return spark.read.option("basePath", path).schema(log_schema(table)).parquet(*folders)


def read_log(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    r = spark.read.option("basePath", path)
    if table:
        r = r.schema(log_schema(table))
    return r.parquet(path)


def resolve(log: DataFrame, table: str, batch_col: str = "_batch_id") -> DataFrame:
    """Apply the key rule of ``table`` to a log with ``batch_col`` and ``_wseq``."""
    cols = COLUMNS[table] + [c for c in ("detected_by", "arrival_ts", "event_date") if c in log.columns]
    rule = RULE[table]
    if rule == "append":
        return log.select(*cols)
    # event_date is a function of the key's ``time``: grouping by it too changes
    # nothing, but lets a filter on event_date pass the aggregate (partition pruning).
    keys = KEYS[table] + (["event_date"] if "event_date" in log.columns else [])
    order = F.struct(*[F.col(c) for c in ("_written",) if c in log.columns], F.col(batch_col).alias("b"),
                     F.col("_wseq").alias("w"))
    payload = F.struct(*[F.col(c) for c in cols if c not in keys])
    pick = F.max_by(payload, order) if rule == "latest" else F.min_by(payload, order)
    return log.groupBy(*keys).agg(pick.alias("_v")).select(*keys, "_v.*").select(*cols)


#: What a compacted copy keeps of the write that won a key.
_ORDER = "_written BIGINT, _batch_id BIGINT, _wseq STRUCT<b: BIGINT, k: INT, s: BIGINT>, _run_id STRING"
_ORDER_COLS = ("_written", "_batch_id", "_wseq", "_run_id")


def _winners(rows: DataFrame, table: str) -> DataFrame:
    """``resolve`` that keeps the order of the write beside each row, so that its result can be resolved again."""
    cols = [*_visible(table), *_ORDER_COLS]
    if RULE[table] == "append":
        return rows.select(*cols)
    keys = [*KEYS[table], "event_date"]
    order = F.struct("_written", F.col("_batch_id").alias("b"), F.col("_wseq").alias("w"))
    payload = F.struct(*(F.col(c) for c in cols if c not in keys))
    pick = F.max_by(payload, order) if RULE[table] == "latest" else F.min_by(payload, order)
    return rows.groupBy(*keys).agg(pick.alias("_v")).select(*keys, "_v.*").select(*cols)


def _visible(table: str) -> list[str]:
    return [*Ty.StructType.fromDDL(_TYPES[table]).names, "arrival_ts", "event_date"]


def _on_days(entries: list) -> Column:
    """Whether a row is of a day that the entries touch: literals, so that partitions are pruned."""
    days = sorted({d for e in entries for d in e["days"]})
    dated = [d for d in days if d != "__HIVE_DEFAULT_PARTITION__"]
    on = F.col("event_date").isin([F.lit(d).cast("date") for d in dated]) if dated else F.lit(False)
    return F.coalesce(on, F.lit(False)) | F.col("event_date").isNull() if len(dated) < len(days) else F.coalesce(on, F.lit(False))


def _merged(spark: SparkSession, path: str, table: str, out_path: str, entries: list) -> tuple[DataFrame, DataFrame]:
    """(the winners of the days that ``entries`` touch, the copy's rows of the other days)."""
    base = _read_copy(spark, out_path, table)
    on = _on_days(entries)
    # A compaction that died halfway may have put some of these batches into the copy already.
    again = spark.createDataFrame([(e["run_id"], e["batch_id"]) for e in entries], "_run_id STRING, _batch_id BIGINT")
    old = base.where(on).join(again, ["_run_id", "_batch_id"], "left_anti")
    new = read_batches(spark, path, table, entries)
    return _winners(old.unionByName(new.select(*old.columns)), table), base.where(~on)


def read_table(spark: SparkSession, path: str, table: str, compacted: str | None = None) -> DataFrame:
    """The table as the reference's database would hold it; with ``compacted``, a copy that ``compact`` keeps, the
    batches that it covers are not read."""
    if compacted is None:
        return resolve(read_batches(spark, path, table, commits(spark, path).collect()), table)
    entries = uncovered(spark, path, compacted)
    if not entries:
        return read_compacted(spark, compacted, table)
    touched, rest = _merged(spark, path, table, compacted, entries)
    return touched.select(*_visible(table)).unionByName(rest.select(*_visible(table)))


def compact(spark: SparkSession, path: str, table: str, out_path: str) -> DataFrame:
    """The resolved rows of a table log, by day, in ``out_path``; which batches it covers is kept beside it, in
    ``<out_path>.covered``, written last. Only days that uncovered batches touch are read and replaced. One
    compaction of a copy at a time; writers need not wait."""
    entries = uncovered(spark, path, out_path)
    if entries:
        touched, _ = _merged(spark, path, table, out_path, entries)
        # Written aside first: a copy cannot be read and replaced in one job.
        _write_days(materialize(touched), out_path, replace_all=False)
        done = [(e["run_id"], e["batch_id"], e["attempt"]) for e in entries]
        spark.createDataFrame(done, ENTRY).coalesce(1).write.mode("append").json(f"{out_path}.covered")
    return read_compacted(spark, out_path, table)


def _read_copy(spark: SparkSession, out_path: str, table: str) -> DataFrame:
    fields = f"{_TYPES[table]}, arrival_ts TIMESTAMP, {_ORDER}, event_date DATE"
    if not path_exists(spark, out_path):
        return spark.createDataFrame([], fields)
    return spark.read.schema(fields).parquet(out_path)


def read_compacted(spark: SparkSession, out_path: str, table: str) -> DataFrame:
    """A compacted copy, with its known schema; empty if nothing was compacted yet."""
    return _read_copy(spark, out_path, table).select(*_visible(table))


def _write_days(df: DataFrame, out_path: str, replace_all: bool = True) -> None:
    """Rows by day, sorted by (meter_id, time desc) inside files (the reference's access path)."""
    if "event_date" not in df.columns:
        df = df.withColumn("event_date", F.to_date("time"))
    # REBALANCE: AQE hash-partitions by day, splits a day that is too big over
    # several tasks and merges small ones, so each task writes few, sizeable files.
    (df.hint("rebalance", "event_date")
     .sortWithinPartitions("event_date", "meter_id", F.desc("time"))
     .write.mode("overwrite").option("partitionOverwriteMode", "static" if replace_all else "dynamic")
     .partitionBy("event_date").parquet(out_path))


def write_compacted(df: DataFrame, out_path: str) -> DataFrame:
    """Write resolved rows by day into a fresh folder; read back with the known schema."""
    _write_days(df, out_path)
    fields = [f for f in df.schema.fields if f.name != "event_date"] + [Ty.StructField("event_date", Ty.DateType())]
    return df.sparkSession.read.schema(Ty.StructType(fields)).parquet(out_path)


def resolve_routed(df: DataFrame, table: str) -> DataFrame:
    """Key rule applied to a routed batch result, arrival bucket as the batch id."""
    return resolve(write_order(df, table), table, batch_col="_bucket")
