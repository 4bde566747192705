"""The pipeline: every stage on awkward rows, and its decisions against brute force."""

from collections import Counter

import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F

from tsquality.llm import queries

from edge import documents, split, stored
from test_text import plain_components, plain_counts, plain_fingerprint


@pytest.fixture()
def folder(spark, tmp):
    stored(documents(spark, 150), tmp, "documents")
    stored(spark.createDataFrame([(1, 1, 0), (None, 1, 0), (1, 1, 0)], "doc_id BIGINT, quality INT, toxic INT"), tmp, "labels")
    return tmp


def rows_of(df):
    return Counter(str(r) for r in df.collect())


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    told = stored(C.language_id(spark, docs, folder), folder, "a")
    assert told.columns == names and not rows_of(told) - rows_of(docs)
    assert all(any(c.isalpha() for c in r.text) for r in told.collect())
    assert told.where("lang IS NOT NULL").count() > 0.9 * docs.where("lang IS NOT NULL").count()
    good = stored(C.quality_rules(spark, told, folder), folder, "b")
    assert good.columns == names
    assert rows_of(good) == Counter(str(r) for r in told.collect() if not plain_counts(r.text)[-1])
    single = stored(C.simhash_near_dedup(spark, good, folder), folder, "c")
    assert single.columns == names and not rows_of(single) - rows_of(good)
    before = [plain_fingerprint(r.text, 3) for r in good.collect()]
    after = [plain_fingerprint(r.text, 3) for r in single.collect()]
    assert len(after) == len(set(plain_components(before, 2))) == len(set(plain_components(after, 2)))
    mix = stored(C.mixing(spark, single, folder), folder, "d")
    assert mix.columns == names
    size = Counter()
    for r in single.collect():
        size[r.source] += len(split(r.text))
    taken = Counter()
    for r in mix.collect():
        taken[r.source] += len(split(r.text))
        assert r.n_chars == len(r.text)
    assert abs(sum(taken.values()) - sum(size.values())) <= len(size)
    pieces = C.packing(spark, mix, folder)
    tokens = pieces.agg(F.sum("length")).first()[0]
    assert tokens == sum(r.doc_tokens for r in pieces.where("start = 0").collect())


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert C.run(spark, folder).count() > 0
    none = str(tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    docs.write.parquet(f"{none}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{none}/labels.parquet")
    assert C.run(spark, none).collect() == []
    assert len(C.STAGES) == 5


@pytest.mark.parametrize("stage", ["quality_rules", "simhash_near_dedup", "mixing"])
def test_rows_are_numbered_once(spark, folder, stage):
    """Scans of the input that are split in other ways after the operator's jobs give the same rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").repartition(3)
    docs = stored(docs, folder, "parts")
    fn = dict(C.STAGES)[stage]
    want = rows_of(fn(spark, docs, folder))
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a file a split
        out = fn(spark, docs, folder)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")  # all files in one split
        assert rows_of(out) == want
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_every_operator_is_registered():
    import __spark_entry__ as E
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
