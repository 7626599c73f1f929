"""The operators' queries on whole test tables: against SQL, and complete."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from rankwright.llm.oracles import oracle_sql
from rankwright.llm.queries import queries

SCALE = "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "pages", "conversations")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SCALE}/{name}.parquet'")
    return connection


def normal(df):
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    ours = normal(queries()[name](spark, SCALE).toPandas())
    theirs = normal(sql.sql(oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False)


def test_every_operator_and_the_pipeline_are_registered():
    known = entry_points.queries()
    assert set(queries()) | {"pipeline"} <= set(known)
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in known) == 1
    assert set(oracle_sql()) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize(("name", "table", "key"), [("op2_katz_backoff", "documents", "doc_id"), ("op5_sentence_spans", "documents", "doc_id"), ("op7_line_blocks", "pages", "page_id")])
def test_one_row_for_every_row(spark, sql, name, table, key):
    got = sorted(r[0] for r in queries()[name](spark, SCALE).select(key).collect())
    assert got == [x for (x,) in sql.sql(f"SELECT {key} FROM {table} ORDER BY 1").fetchall()]
