"""Queries over the driver's tables, one for each operator: each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsquality.llm import langid, oracle
from tsquality.llm.codes import coded
from tsquality.llm.common import byte_bpe, crc_mod, table
from tsquality.llm.decontaminate import contaminated
from tsquality.llm.extract import extracted
from tsquality.llm.knn import top_k
from tsquality.llm.lm import scored
from tsquality.llm.mixing import mixed
from tsquality.llm.packing import pack_documents
from tsquality.llm.quality import judged
from tsquality.llm.resample import resampled
from tsquality.llm.simhash import fingerprint_text, near_duplicates
from tsquality.llm.tokenids import token_archive
from tsquality.llm.warc import archived


def op1_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), byte_bpe())


def op2_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), held_out=crc_mod("doc_id", 10) == 0)


def op3_chunked_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


def op4_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


def op5_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), is_query=F.col("id") % 50 == 0)


def op6_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def op7_word_first_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    model = langid.fit(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.predict(model, rows).select("doc_id", "held_out", "lang_pred", "score")


def op8_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), fingerprint_text("fp").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_archive(table(spark, sf_dir, "documents"), byte_bpe())


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(table(spark, sf_dir, "embeddings"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_lexical_packing, op2_backoff_automaton, op3_chunked_warc, op4_entropy_mix, op5_voronoi_knn, op6_line_blocks,
    op7_word_first_langid, op8_simhash_tiles, op9_quality_rules, op10_token_archive,
    op11_importance_resampling, op12_vector_codes, op13_decontamination)}

ORACLE_SQL: dict[str, str] = oracle.SQL
