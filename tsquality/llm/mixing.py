"""Mixing sources to target weights by entropy balancing.

Targets: sources share all words by weight; none takes more than ``limit`` times its own words, and
what is over goes to the others by weight (water-filling, solved in one pass over the sorted
sources). Rates: of all document rates between 0 and ``limit`` that meet a source's target, those
with the greatest entropy around rate 1 are

    rate = limit / (1 + (limit - 1) * exp(-lambda * size / mean size)),

exponentially tilted odds with one dual variable a source. Newton iterations on the convex dual find
lambda. Rates depend on (source, size) alone, so an iteration is one aggregation over the distinct
pairs, kept in brackets by bisection; only numbers about convergence come to the driver. Copies: within a
source, documents in order of size get the whole numbers that their running rate passes, which
keeps words within a document of the target; the rest is taken from, or given to, one document,
which the mix takes in part. Running sums are added up over ranges of (source, size, id), so that a
source with a third of all rows is not one task's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tsquality.llm.common import parts_for, written


def word_count(text: Column) -> Column:
    words = F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return F.size(words).cast("bigint")


def targets(sources: DataFrame, weights: tuple[float, ...], limit: float) -> DataFrame:
    """``sources`` (source, source_size; a row a source) with target."""
    order = W.Window.orderBy(F.col("source").isNull(), "source")  # strings order by UTF-8 bytes: by code point
    place = (F.row_number().over(order) - 1) % len(weights) + 1
    d = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place).cast("double"))
    d = d.withColumn("cap", limit * F.col("source_size"))
    by_level = W.Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_level.rowsBetween(W.Window.unboundedPreceding, -1)
    every = W.Window.orderBy(F.lit(0)).rowsBetween(W.Window.unboundedPreceding, W.Window.unboundedFollowing)
    d = d.withColumns({"total": F.sum("source_size").over(every), "all_weight": F.sum("weight").over(every)})
    d = d.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # The first level at which the next source is not capped holds for all that are not.
    d = d.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(every))
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return d.select("source", "source_size", target.cast("double").alias("target"))


def rate(lam: Column, size: Column, limit: float) -> Column:
    """``lam`` null: the source takes all it may."""
    return F.when(lam.isNull(), F.lit(float(limit))).otherwise(limit / (1 + (limit - 1) * F.exp(-lam * size)))


def solved(pairs: DataFrame, sources: DataFrame, limit: float, tolerance: float = 1e-9, max_rounds: int = 60) -> DataFrame:
    """``sources`` with mean and lam. ``pairs``: source, size, n."""
    mean = pairs.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.greatest(F.sum("n"), F.lit(1))).alias("mean")) \
        .withColumnRenamed("source", "p_source")
    state = sources.join(mean, F.col("source").eqNullSafe(F.col("p_source"))).select(
        "source", "source_size", "target", F.greatest("mean", F.lit(1e-300)).alias("mean"),
        F.lit(0.0).alias("lam"), F.lit(-1e9).alias("low"), F.lit(1e9).alias("high"))
    state = written(state, "dual")
    pairs = pairs.withColumnRenamed("source", "p_source")
    few = state.count() <= 10_000  # a row a source: broadcast only where that is few
    for _ in range(max_rounds):
        x = F.col("size") / F.col("mean")
        r = rate(F.col("lam"), x, limit)
        sums = pairs.join(F.broadcast(state) if few else state, F.col("p_source").eqNullSafe(F.col("source"))) \
            .groupBy("source", "source_size", "target", "mean", "lam", "low", "high").agg(
                F.sum(F.col("n") * F.col("size") * r).alias("words"),
                F.sum(F.col("n") * F.col("size") * x * r * (1 - r / limit)).alias("slope"))
        gap = F.col("words") - F.col("target")
        done = F.abs(gap) <= tolerance * F.greatest("target", F.lit(1.0))
        low = F.when(gap < 0, F.greatest("low", "lam")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.least("high", "lam")).otherwise(F.col("high"))
        step = F.col("lam") - F.greatest(F.lit(-8.0), F.least(F.lit(8.0), gap / F.greatest("slope", F.lit(1e-300))))
        new = F.when(done, F.col("lam")).when((step > low) & (step < high), step).otherwise((low + high) / 2)
        state = written(sums.select("source", "source_size", "target", "mean", new.alias("lam"), low.alias("low"),
                                    high.alias("high"), done.alias("done")), "dual")
        left = state.where((~F.col("done")) & (F.col("target") < limit * F.col("source_size") * (1 - 1e-12))).count()
        state = state.drop("done")
        if not left:
            break
    full = F.col("target") >= limit * F.col("source_size") * (1 - 1e-12)
    return state.select("source", "source_size", "target", "mean", F.when(~full, F.col("lam")).alias("lam"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[float, ...] = (1, 2, 3), limit: int = 3, part_rows: int = 200_000,
          row: Column | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of ``docs``; with ``row`` also that column.

    ``taken`` is size times the whole copies, plus or minus the part that one document of each source
    gives. A null text has size 0 and takes 0; a null source is a source, the last; rows with equal
    ids count each; a source of nothing but empty texts has target 0; an empty table gives no row.
    Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       word_count(F.col(text_col)).alias("size"), *([row.alias("row")] if row is not None else []))
    rows = written(rows, "sizes")
    total = rows.count()
    keys = ["source", "size", "doc_id", *(["row"] if row is not None else [])]
    dealt = rows.repartitionByRange(parts_for(total, part_rows), *keys).sortWithinPartitions(*keys) \
        .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    dealt = written(dealt, "dealt")
    pairs = written(dealt.groupBy("source", "size").agg(F.count("*").alias("n")), "pairs")
    sources = pairs.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    dual = solved(pairs, targets(sources, weights, limit), limit)
    few = dual.count() <= 10_000  # a row a source
    hint = F.broadcast if few else (lambda x: x)
    d = dealt.join(hint(dual.withColumnRenamed("source", "s_source")), F.col("source").eqNullSafe(F.col("s_source"))).select(
        *dealt.columns, "source_size", "target", rate(F.col("lam"), F.col("size") / F.col("mean"), limit).alias("rate"))
    # Running rates: inside a part by a window, over parts by their sums.
    sums = d.groupBy("source", "part").agg(F.sum("rate").alias("sum"))
    over = W.Window.partitionBy("source").orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)
    sums = sums.select("source", "part", F.coalesce(F.sum("sum").over(over), F.lit(0.0)).alias("before"))
    within = W.Window.partitionBy("source", "part").orderBy("at")
    d = d.withColumn("upto", F.sum("rate").over(within.rowsBetween(W.Window.unboundedPreceding, 0)))
    sums = sums.withColumnsRenamed({"source": "s_source", "part": "s_part"})
    d = d.join(sums, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("part") == F.col("s_part")))
    end = F.floor(F.col("before") + F.col("upto") + 0.5)
    begin = F.floor(F.col("before") + F.coalesce(F.lag("upto").over(within), F.lit(0.0)) + 0.5)
    copies = F.greatest(F.lit(0), F.least(F.lit(limit), end - begin)).cast("bigint")
    d = written(d.select(*dealt.columns, "source_size", "target", copies.alias("copies")), "copies")
    # What is missing or over goes to one document a source: the one with most room for it.
    taken = F.col("size") * F.col("copies")
    least_at = -F.col("at")
    gap = d.groupBy("source").agg(
        (F.round(F.first("target")) - F.sum(taken)).cast("bigint").alias("gap"),
        F.max(F.struct((F.col("size") * limit - taken).alias("room"), least_at.alias("at"))).alias("up"),
        F.max(F.struct(taken.alias("room"), least_at.alias("at"))).alias("down"))
    gap = gap.select(F.col("source").alias("g_source"),
                     F.when(F.col("gap") > 0, -F.col("up.at")).when(F.col("gap") < 0, -F.col("down.at")).alias("g_at"),
                     F.when(F.col("gap") > 0, F.least("gap", "up.room"))
                     .otherwise(-F.least(-F.col("gap"), F.col("down.room"))).alias("part_words"))
    d = d.join(hint(gap), F.col("at") == F.col("g_at"), "left")
    return d.select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.col("copies") + F.coalesce("part_words", F.lit(0))).cast("bigint").alias("taken"),
                    *(["row"] if row is not None else []))
