"""The registered queries on the driver's small tables: those with SQL against DuckDB, all for shape."""

import os
import zlib

import duckdb
import pytest
from tools.compare import TABLES, digest

from tsquality.llm import queries

SF = "/root/testdata/sf0.001"
ROWS = {"op3": "pages", "op6": "pages"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{SF}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(cols, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL) - {"op1_lexical_packing"}))
def test_a_row_for_each_input_row(spark, con, name):
    table = ROWS.get(name.split("_")[0], "documents")
    ids = [r[0] for r in con.execute(f"SELECT {'page' if table == 'pages' else 'doc'}_id FROM {table}").fetchall()]
    rows = queries.QUERIES[name](spark, SF).collect()
    assert sorted(r[0] for r in rows) == sorted(ids)


def test_held_out_language_accuracy(spark, con):
    """Predictions for rows that the model did not learn from."""
    lang = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = queries.op7_word_first_langid(spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert sum(held) >= 0.97 * len(held) > 20


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = [r for r in queries.op2_backoff_automaton(spark, SF).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
