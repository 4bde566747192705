"""CSV readings.

Column aliases (fixed values, first non-empty value wins, in this order):
  meter id      meter_id, meterId, id
  time          timestamp, time, datetime
  consumption   consumption_kwh, consumption, kwh
The third-party converter looks the id up as meter_id, id, meterId (default
'UNKNOWN') and also takes ``value`` for the consumption.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tsquality.functions.numeric import parse_float
from tsquality.functions.time import parse_iso_timestamp
from tsquality.session import materialize, settings

METER_ALIASES = ("meter_id", "meterId", "id")
TIME_ALIASES = ("timestamp", "time", "datetime")
KWH_ALIASES = ("consumption_kwh", "consumption", "kwh")
CONVERT_METER_ALIASES = ("meter_id", "id", "meterId")
CONVERT_KWH_ALIASES = ("consumption_kwh", "consumption", "kwh", "value")


#: What a stream gives by name: every alias that the parser or the converter looks for.
STREAM_COLUMNS = tuple(dict.fromkeys((*METER_ALIASES, *TIME_ALIASES, *CONVERT_KWH_ALIASES)))

#: So large that each file is one split and each split one partition.
_WHOLE = str(1 << 44)

#: Tables of files up to this many rows (a path and some positions each) are broadcast.
MOST_BROADCAST_FILES = 100_000


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, place of the split, line) to (file, header); a partition holds one file, and is read as far as its header."""
    lines, file = [], None
    for b in batches:
        if not b.num_rows:
            continue
        if b.column(1)[0].as_py() != 0:
            return
        file = b.column(0)[0].as_py()
        lines += [x or "" for x in b.column(2).to_pylist()]
        if any(lines):
            break
    header = next((h for h in csv.reader(x.removeprefix("\ufeff") + "\n" for x in lines) if h), None)
    if header:
        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([header], pa.list_(pa.string()))], names=["file", "header"])


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """file, header: the first row of each CSV file, read by a task a file that stops there."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("start"), "value")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": _WHOLE, "spark.sql.files.openCostInBytes": _WHOLE}):
        return materialize(lines.mapInArrow(_first_rows, "file STRING, header ARRAY<STRING>"))


def _output_names(names: Iterable[str]) -> dict[str, str]:
    """Header names to column names. Spark does not tell ``ID`` from ``id``: lower-case ones keep
    their name, another that clashes gets underscores."""
    out: dict[str, str] = {}
    taken: set[str] = set()
    for name in sorted(names, key=lambda n: (n != n.lower(), n)):
        column = name
        while column.lower() in taken:
            column += "_"
        taken.add(column.lower())
        out[name] = column
    return out


def read_csv(spark: SparkSession, path: str, stream: bool = False, multi_line: bool = True) -> DataFrame:
    """Header row, every column as text (no inference). A missing path fails.

    Files may differ in their headers: columns are matched by name (the first of equal names in a
    header counts), and a column that a file lacks is null there. A doubled quote inside quotes is a
    quote. ``multi_line`` lets a quoted field hold line breaks, which keeps a file in one task; switch it
    off for large files without such fields. Headers are read by tasks, never by the driver, which gets the
    distinct ones alone. A stream has the columns of :func:`stream_csv`.
    """
    if stream:
        return stream_csv(spark, path)
    headers = file_headers(spark, path)
    kinds = [r["header"] for r in headers.select("header").distinct().collect()]  # a row a distinct header
    names = _output_names({n for h in kinds for n in h if n})
    if not names:
        return spark.createDataFrame([], ", ".join(f"{c} STRING" for c in ("meter_id", "timestamp", "consumption_kwh")))
    width = max(map(len, kinds))
    cells = [f"_c{k}" for k in range(width)]
    rows = spark.read.options(header=True, escape='"', multiLine=multi_line) \
        .schema(", ".join(f"{c} STRING" for c in cells)).csv(path)
    if len(kinds) == 1:
        return rows.select(*(F.col(cells[kinds[0].index(n)]).alias(c) for n, c in names.items()))
    place = F.array(*(F.nullif(F.array_position("header", n), F.lit(0)) - 1 for n in names))
    places = headers.select("file", place.cast("array<int>").alias("_at"))
    if headers.count() <= MOST_BROADCAST_FILES:
        places = F.broadcast(places)
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.array(*cells).alias("_cells")).join(places, "file", "left")
    at = F.coalesce("_at", F.raise_error(F.concat(F.lit("no header was read of "), F.col("file"))).cast("array<int>"))
    rows = rows.select("_cells", at.alias("_at"))
    return rows.select(*(F.get("_cells", F.get("_at", F.lit(k))).alias(c) for k, c in enumerate(names.values())))


def _named(columns: tuple[str, ...]):
    """(cells ..., file) to ``columns``: the first row of each file says where they stand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, at = None, {}
        for b in batches:
            if not b.num_rows:
                continue
            *cells, files = b.columns
            n, given = b.num_rows, files.to_pylist()
            cuts = [0, *(k for k in range(1, n) if given[k] != given[k - 1]), n] if given[0] != given[-1] else [0, n]
            for lo, hi in zip(cuts, cuts[1:]):
                if given[lo] != file:
                    header = [c[lo].as_py() or "" for c in cells]
                    if header[-1]:
                        raise ValueError(f"{given[lo]} has more than {len(cells) - 1} columns")
                    file, lo = given[lo], lo + 1
                    header[0] = header[0].removeprefix("\ufeff")
                    at = {name: k for k, name in reversed(list(enumerate(header)))}
                if lo < hi:
                    yield pa.RecordBatch.from_arrays(
                        [cells[at[c]].slice(lo, hi - lo) if c in at else pa.nulls(hi - lo, pa.string()) for c in columns],
                        names=list(columns))
    return run


def stream_csv(spark: SparkSession, path: str, columns: tuple[str, ...] = STREAM_COLUMNS, most_columns: int = 32,
               files_per_trigger: int | None = None) -> DataFrame:
    """S1 as a stream: ``columns`` as text, from files that each have a header of their own and may arrive any time.

    A file is read by one task, its header where its rows are; a column that it lacks is null. Line breaks
    inside quotes are kept. A header of more than ``most_columns`` fails the stream: no cell is dropped unseen.
    """
    cells = [f"_c{k}" for k in range(most_columns + 1)]
    reader = spark.readStream.options(header=False, escape='"', multiLine=True).schema(", ".join(f"{c} STRING" for c in cells))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.csv(path).select(*cells, F.col("_metadata.file_path").alias("file"))
    return rows.mapInArrow(_named(columns), ", ".join(f"`{c}` STRING" for c in columns))


def first_present(df: DataFrame, names) -> Column:
    """First non-empty value among the alias columns that exist (Python ``a or b or c``)."""
    cols = [F.nullif(F.col(f"`{n}`"), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*cols) if cols else F.lit(None).cast("string")


def parse_csv_rows(df: DataFrame, keep: tuple[str, ...] = (), observation: Observation | str | None = None) -> DataFrame:
    """Aliased text rows -> meter_id, timestamp (UTC), consumption_kwh.

    Rows lacking a field, with an unreadable time (ISO, else
    ``yyyy-MM-dd HH:mm:ss``) or a non-numeric value are dropped; an
    ``observation`` counts them (``rows``, ``dropped``) as the rows pass; for a
    stream it is a name, and :mod:`tsquality.streaming.counts` reads them a micro-batch.
    """
    mid = first_present(df, METER_ALIASES)
    ts_text = first_present(df, TIME_ALIASES)
    kwh_text = first_present(df, KWH_ALIASES)
    out = df.select(*keep, mid.alias("meter_id"),
                    parse_iso_timestamp(ts_text, fallback_plain=True).alias("timestamp"),
                    parse_float(kwh_text).alias("consumption_kwh"))
    whole = F.col("meter_id").isNotNull() & F.col("timestamp").isNotNull() & F.col("consumption_kwh").isNotNull()
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"), F.count_if(~whole).alias("dropped"))
    return out.where(whole)


def convert_to_standard(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """S3: third-party rows -> standard text rows (meter_id, timestamp, consumption_kwh).

    The time text is passed on, with spaces turned into 'T' unless it already
    holds a 'T' and does not end in 'Z'; rows with a non-numeric value are skipped.
    """
    mid = F.coalesce(first_present(df, CONVERT_METER_ALIASES), F.lit("UNKNOWN"))
    ts = first_present(df, TIME_ALIASES)
    kwh = first_present(df, CONVERT_KWH_ALIASES)
    iso_like = ts.contains("T") & ~ts.endswith("Z")
    ts_out = F.when(iso_like, ts).when(ts.contains(" "), F.regexp_replace(ts, " ", "T")).otherwise(ts)
    out = df.select(*keep, mid.alias("meter_id"), ts_out.alias("timestamp"), parse_float(kwh).alias("consumption_kwh"))
    return out.where(F.col("timestamp").isNotNull() & F.col("consumption_kwh").isNotNull())


def write_standard_csv(df: DataFrame, path: str) -> None:
    """S3 sink: standard header ``meter_id,timestamp,consumption_kwh``."""
    df.select("meter_id", "timestamp", "consumption_kwh").write.mode("overwrite").option("header", True).csv(path)
