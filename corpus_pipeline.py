"""The training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read again
as the next one's ``docs``. All but the last give the columns of ``documents`` (whatever these are
besides doc_id, text, lang and source); rows that a stage rejects go, and the mix repeats rows. A
stage refers to rows by a number that it writes beside each row first, so repeated or null ids lose and
gain nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsquality.llm import langid
from tsquality.llm.common import byte_bpe, crc_mod, table, written
from tsquality.llm.mixing import mixed
from tsquality.llm.packing import pack_documents
from tsquality.llm.quality import judged
from tsquality.llm.simhash import near_duplicates
from tsquality.session import prepare


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a row number, written: another scan may be split, and so numbered, in another way."""
    row = _free(docs, "row_number_")
    return written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told with a score of at least one half (operator 7).

    Null texts and texts without letters are rejected; without any labelled row, nothing else is.
    """
    prepare(spark)
    model = langid.fit(docs.where(crc_mod("doc_id", 4) != 2))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told, score = _free(docs, "lang_pred"), _free(docs, "score")
    found = langid.predict(model, docs, names=(told, score))
    return found.where((_col(told) != "und") & (_col(score) >= 0.5)).drop(told, score)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass the base rules and the risk-controlled thresholds (operator 9)."""
    prepare(spark)
    numbered, row = _numbered(docs)
    verdicts = judged(numbered, table(spark, sf_dir, "labels"), row=_col(row))
    return numbered.join(verdicts.where("kept").select(F.col("row").alias(row)), row, "left_semi").drop(row)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first row of each component of near-duplicates (operator 8)."""
    prepare(spark)
    numbered, row = _numbered(docs)
    found = near_duplicates(numbered, id_col=row)
    first = found.where("id = component").select(F.col("id").alias(row))
    return numbered.join(first, row, "left_semi").drop(row)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them (operator 4): of what it takes beyond whole copies, a row has
    the document's first words, joined by spaces (and their length as n_chars, if there is such a column)."""
    prepare(spark)
    numbered, row = _numbered(docs)
    size, taken, copy = (_free(docs, n) for n in ("size_", "taken_", "copy_"))
    found = mixed(numbered, row=_col(row)).where("taken > 0").select(
        F.col("row").alias(row), F.col("size").alias(size), F.col("taken").alias(taken))
    d = numbered.join(found, row)
    whole, rest = F.floor(_col(taken) / _col(size)), _col(taken) % _col(size)
    d = d.withColumn(copy, F.explode(F.sequence(F.lit(1), (whole + F.when(rest > 0, 1).otherwise(0)).cast("int"))))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    cut = _col(copy) > whole
    d = d.withColumn("text", F.when(cut, F.array_join(F.slice(words, 1, rest.cast("int")), " ")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        d = d.withColumn("n_chars", F.when(cut, n_chars).otherwise(F.col("n_chars")))
    return d.select(*map(_col, docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens (operator 1)."""
    prepare(spark)
    return pack_documents(docs, byte_bpe())


STAGES = [("language_id", language_id), ("quality_rules", quality_rules), ("simhash_near_dedup", simhash_near_dedup),
          ("mixing", mixing), ("packing", packing)]

#: Language scores, fingerprints, the mix's Newton rounds and the packing have no SQL; tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
