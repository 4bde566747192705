"""Quality rules with risk-controlled thresholds, in DataFrame functions alone.

A rule rejects a document whose measure reaches its cutoff. For each stratum (a column's value, null
being one), the cutoffs of all rules are found together, by steps along a fixed path: it begins with
no rule on, and each step takes one rule's next stricter cutoff, the rules in turn. A step is taken
only if labelled good documents show that all rules together then reject few good ones: with n good
holdout documents of the stratum, k of them rejected by any rule, P(Bin(n, a) <= k) <= d must hold,
that is the exact (Clopper-Pearson) upper bound of the false rejection rate at confidence 1 - d must
be at most a. The first step that fails ends the stratum's path. As the path is fixed beforehand and
nothing is tested beyond the first failure, all its tests share one d (fixed-sequence testing): a is
``max_false``, d is ``error`` over the number of strata, so that all bounds hold at once. A stratum
with too few labels for the first step has all rules switched off.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsquality.llm.common import written

#: Fixed grids, strictest first. Measures: symbols a word; share of lines that repeat an earlier
#: line; share of words in repeated 3-word windows; code points a word.
GRIDS: dict[str, list[float]] = {
    "symbol_rate": [0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0],
    "dup_line_share": [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.75],
    "repeat_share": [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45],
    "word_length": [8.0, 9.0, 10.0, 12.0, 14.0, 16.0, 20.0],
}
#: The path of steps, loosest first: a rule and its next cutoff, rules in turn by the share of their grid.
PATH: list[tuple[str, float]] = [(r, c) for _, r, c in sorted(
    ((len(grid) - k) / len(grid), r, c) for r, grid in GRIDS.items() for k, c in enumerate(grid))]
_SPACES = r"[\x20\x09-\x0D]+"


def measures(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` (whose columns must not begin with ``_q``) with the counts of ``text`` in a struct ``_q``."""
    none = F.array().cast("array<bigint>")
    d = rows.withColumn("_qtext", F.coalesce(text.cast("string"), F.lit("")))
    d = d.withColumn("_qwords", F.array_remove(F.split("_qtext", _SPACES), ""))
    d = d.withColumn("_qlines", F.filter(F.split("_qtext", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size("_qwords")
    # A 3-word window as one number; equal numbers stand for equal windows (64 bits, one document).
    d = d.withColumn("_qwin", F.when(n >= 3, F.transform(
        F.slice("_qwords", 1, F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("_qwords", i + 1), F.get("_qwords", i + 2)))).otherwise(none))
    pair = "array<struct<h:bigint,i:int>>"
    d = d.withColumn("_qsorted", F.when(
        F.size(F.array_distinct("_qwin")) < F.size("_qwin"),
        F.sort_array(F.transform("_qwin", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ).otherwise(F.array().cast(pair)))
    # Neighbours in sorted order with equal windows: both windows' words are repeated.
    d = d.withColumn("_qsame", F.filter(
        F.arrays_zip(F.col("_qsorted").alias("a"), F.slice("_qsorted", 2, F.greatest(F.size("_qsorted"), F.lit(1))).alias("b")),
        lambda p: p["a"]["h"] == p["b"]["h"]))
    covered = F.size(F.array_distinct(F.flatten(F.transform("_qsame", lambda p: F.array(
        *(p[side]["i"] + k for side in ("a", "b") for k in range(3)))))))
    text_length = F.length("_qtext")
    q = F.struct(
        n.cast("bigint").alias("n_words"),
        F.length(F.translate("_qtext", " \t\n\x0b\f\r", "")).cast("bigint").alias("word_chars"),
        (text_length - F.length(F.translate("_qtext", "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        (F.size("_qlines") - F.size(F.array_distinct("_qlines"))).cast("bigint").alias("n_dup_lines"),
        covered.cast("bigint").alias("n_repeat_words"),
        F.size("_qlines").cast("bigint").alias("n_lines"))
    return d.select(*(F.col(f"`{c}`") for c in rows.columns), q.alias("_q"))


def base_failed(q: str = "_q", min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    return ((F.col(f"{q}.n_words") < min_words)
            | (100 * F.col(f"{q}.n_repeat_words") > max_repeat_percent * F.col(f"{q}.n_words")))


def rates(q: str = "_q") -> dict[str, Column]:
    def share(a, b):
        return F.when(F.col(f"{q}.{b}") > 0, F.col(f"{q}.{a}") / F.col(f"{q}.{b}")).otherwise(0.0)
    return {"symbol_rate": share("n_symbols", "n_words"), "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"), "word_length": share("word_chars", "n_words")}


def log_binomial_cdf(n: Column, k: Column, p: float) -> Column:
    """ln P(Bin(n, p) <= k), summed term by term in logs."""
    first = n * math.log1p(-p)
    odds = math.log(p) - math.log1p(-p)
    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))

    def add(acc, i):
        t = acc["t"] + F.log((n - i + 1) / i) + odds
        s = F.greatest(acc["s"], t) + F.log1p(F.exp(-F.abs(acc["s"] - t)))
        return F.struct(t.alias("t"), s.alias("s"))
    return F.aggregate(steps, F.struct(first.alias("t"), first.alias("s")), add, lambda acc: acc["s"])


def thresholds(holdout: DataFrame, max_false: float, error: float) -> DataFrame:
    """A row a stratum: its null-able cutoff for each rule. ``holdout``: stratum and the rates of good documents."""
    # Hits are counted in wide columns: a row a stratum and task is all that is shuffled.
    at: dict[str, float] = {}
    hits = {}
    for step, (rule, cutoff) in enumerate(PATH):
        at[rule] = cutoff
        hits[f"hits_{step}"] = F.count_if(reduce(or_, (F.col(r) >= c for r, c in at.items())))
    wide = holdout.groupBy("stratum").agg(F.count("*").alias("n"), *(v.alias(k) for k, v in hits.items()))
    wide = written(wide, "holdout")
    level = math.log(error) - math.log(max(1, wide.count()))
    failed = [log_binomial_cdf(F.col("n"), F.col(h), max_false) > level for h in hits]
    steps = wide.select("stratum", (F.array_position(F.array(*failed, F.lit(True)), True) - 1).alias("steps"))
    steps = written(steps, "steps")  # else each cutoff would have the tests of all steps
    cutoffs = [F.coalesce(*(F.when(F.col("steps") > PATH.index((r, c)), F.lit(c)) for c in grid)).alias(f"cut_{r}")
               for r, grid in GRIDS.items()]
    return steps.select("stratum", *cutoffs)


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
           max_false: float = 0.02, error: float = 0.05, row: Column | None = None) -> DataFrame:
    """doc_id, the counts of ``measures``, base_failed and kept of every row of ``docs``; with ``row``
    also that column.

    A null text counts as empty. Documents whose labels differ count as not good; rows with a
    repeated id share the label; null ids have none. A stratum without labels, like an empty table
    of labels, has no rule beside the base. Other columns of either table are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"),
                       F.col(text_col).alias("_qraw"), *([row.alias("row")] if row is not None else []))
    d = measures(rows, F.col("_qraw")).drop("_qraw")
    d = written(d.select("*", base_failed().alias("base_failed"), *(v.alias(k) for k, v in rates().items())), "measures")
    good = labels.groupBy(F.col(id_col).cast("bigint").alias("doc_id")).agg(F.min("quality").alias("quality")) \
        .where("quality = 1").select("doc_id")
    holdout = d.where("NOT base_failed").join(good, "doc_id").select("stratum", *GRIDS)
    cuts = written(thresholds(holdout, max_false, error), "cutoffs")
    n_cuts = cuts.count()  # a row a stratum: broadcast only where that is few
    joined = d.join(F.broadcast(cuts) if n_cuts <= 10_000 else cuts, d["stratum"].eqNullSafe(cuts["stratum"]), "left")
    rejected = F.lit(False)
    for r in GRIDS:
        rejected = rejected | F.coalesce(F.col(r) >= F.col(f"cut_{r}"), F.lit(False))
    return joined.select("doc_id", "_q.n_words", "_q.word_chars", "_q.n_symbols", "_q.n_dup_lines", "_q.n_repeat_words",
                         "base_failed", (~(F.col("base_failed") | rejected)).alias("kept"),
                         *(["row"] if row is not None else []))
