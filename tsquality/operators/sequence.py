"""Skew-safe ordered scans per key.

Per-meter sequence logic (previous reading, running maximum, next reading) is a
window over each meter's rows in time order. A plain
``Window.partitionBy(meter_id)`` sends every row of a meter to one task; if one
meter holds a third of the data, so does one task. Here each meter's timeline is
cut into segments of ``segment_seconds`` (and hot segments into ranges of the
full order, see below), the window runs per (meter, segment, sub), and what
crosses a segment border is carried by a small per-segment table:

1. ``(key, seg, sub)`` aggregate: max / first / last per segment (map-side combine);
2. a window over that aggregate per key (rows = segments of one key, bounded by
   the time span, not by the data volume) gives the carry-in of each segment;
3. a join back on ``(key, seg, sub)``. The big side is already hash-partitioned
   and sorted on those columns by the window, so only the segment table moves.

Segments with more than ``max_segment_rows`` rows are found by a count per
segment (again map-side combined). Their rows are dealt by Spark's range
partitioning over the whole order, whose last column is unique: so even rows of
one meter in one arrival bucket, or of one instant, are split. A range's number
is the row's ``sub``; these rows are written once, so that both uses of the
ranges see the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsquality.config import DEFAULT, QualityConfig
from tsquality.functions.arith import idiv
from tsquality.session import materialize

SEG, SUB = "_seg", "_sub"


def ordered_scan(df: DataFrame, key: str, pos: str, order: list[str], outputs: list[tuple[str, str, str]],
                 cfg: QualityConfig = DEFAULT, segment_us: int | None = None, hot="detect") -> DataFrame:
    """Add per-key neighbour columns in the order ``order`` (whose first column is ``pos``).

    ``pos`` is a BIGINT that never decreases along ``order`` (event-time micros,
    or arrival-bucket micros); segments are ranges of ``pos``. Rows of a key must
    be totally ordered by ``order`` (end it with a unique column) for ``prev``
    and ``next`` to be deterministic.

    ``hot`` is the hot-segment table from :func:`detect_hot` (``None`` = none);
    by default it is detected here. A subset of rows may reuse its parent's.
    """
    width = segment_width(cfg, segment_us)
    base_cols = df.columns
    d = df.select("*", idiv(F.col(pos), F.lit(width)).alias(SEG))
    if isinstance(hot, str):
        hot = detect_hot(d, key, cfg)
    d = _apply_split(d, key, order, hot)
    parts = [key, SEG, SUB]
    w = Window.partitionBy(*parts).orderBy(*[F.col(c) for c in order])
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    order_struct = F.struct(*[F.col(c) for c in order])
    ws = Window.partitionBy(key).orderBy(SEG, SUB)

    in_cols = [F.lag(F.lit(1)).over(w).isNull().alias("_first"), F.lead(F.lit(1)).over(w).isNull().alias("_last")]
    seg_aggs, carries, finals = [], [], []
    for name, kind, value in outputs:
        tmp_in, tmp_seg, tmp_carry = f"_in_{name}", f"_sg_{name}", f"_cr_{name}"
        if kind == "prev_max":
            in_cols.append(F.max(value).over(before).alias(tmp_in))
            seg_aggs.append(F.max(value).alias(tmp_seg))
            carries.append(F.max(tmp_seg).over(ws.rowsBetween(Window.unboundedPreceding, -1)).alias(tmp_carry))
            finals.append(F.greatest(F.col(tmp_in), F.col(tmp_carry)).alias(name))
        elif kind == "prev":
            in_cols.append(F.lag(value).over(w).alias(tmp_in))
            seg_aggs.append((F.max(value) if value == pos else F.max_by(F.col(value), order_struct)).alias(tmp_seg))
            carries.append(F.lag(tmp_seg).over(ws).alias(tmp_carry))
            finals.append(F.when(F.col("_first"), F.col(tmp_carry)).otherwise(F.col(tmp_in)).alias(name))
        elif kind == "next":
            in_cols.append(F.lead(value).over(w).alias(tmp_in))
            seg_aggs.append((F.min(value) if value == pos else F.min_by(F.col(value), order_struct)).alias(tmp_seg))
            carries.append(F.lead(tmp_seg).over(ws).alias(tmp_carry))
            finals.append(F.when(F.col("_last"), F.col(tmp_carry)).otherwise(F.col(tmp_in)).alias(name))
        else:
            raise ValueError(kind)

    d = d.select("*", *in_cols)
    seg_table = d.groupBy(*parts).agg(*seg_aggs).select(*parts, *carries)
    return d.join(seg_table, on=parts, how="left").select(*[F.col(c) for c in base_cols], *finals)


def segment_width(cfg: QualityConfig, segment_us: int | None) -> int:
    return segment_us or cfg.segment_seconds * 1_000_000


def detect_hot(df: DataFrame, key: str, cfg: QualityConfig = DEFAULT, pos: str | None = None,
               segment_us: int | None = None):
    """Segments holding more than ``max_segment_rows`` rows, with their split count,
    or ``None`` when there are none. At most rows / max_segment_rows entries."""
    if not cfg.max_segment_rows:
        return None
    d = df if SEG in df.columns else df.withColumn(SEG, idiv(F.col(pos), F.lit(segment_width(cfg, segment_us))))
    hot = (d.groupBy(key, SEG).count()
           .where(F.col("count") > cfg.max_segment_rows)
           .select(key, SEG, F.ceil(F.col("count") / F.lit(cfg.max_segment_rows)).cast("bigint").alias("_nsub")))
    hot = materialize(hot, cfg.materialize)
    return hot if hot.count() else None


def _apply_split(d: DataFrame, key: str, order: list[str], hot) -> DataFrame:
    """Add ``_sub``: 0, or for rows of hot segments the number of their range of the full order."""
    if hot is None:
        return d.select("*", F.lit(0).cast("bigint").alias(SUB))
    cols = [F.col(c) for c in d.columns]
    j = d.join(hot, on=[key, SEG], how="left")
    cold = j.where(F.col("_nsub").isNull()).select(*cols, F.lit(0).cast("bigint").alias(SUB))
    parts = int(hot.agg(F.sum("_nsub")).first()[0])
    ranges = j.where(F.col("_nsub").isNotNull()).select(*cols).repartitionByRange(parts, key, SEG, *order)
    ranges = ranges.select("*", (F.spark_partition_id() + F.lit(1)).cast("bigint").alias(SUB))
    return cold.unionByName(materialize(ranges, "checkpoint"))
