"""Every query against the same question in SQL, run by DuckDB."""

import duckdb
import pandas as pd
import pytest
from conftest import ORACLE_SCALE, SMALL

import __spark_entry__ as entry_points
from rankwright.plans.oracles import oracle_sql
from rankwright.plans.queries import queries

TABLES = ("nation", "customer", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{ORACLE_SCALE}/{name}.parquet'")
    return connection


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        kind = df[name].dtype.kind
        if kind == "M":
            df[name] = df[name].astype("datetime64[us]").astype(str)
        elif kind in "iuf":
            df[name] = df[name].astype("float64").round(6)
        else:
            df[name] = df[name].map(lambda v: None if pd.isna(v) else str(v))
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    ours = normal(queries()[name](spark, ORACLE_SCALE).toPandas())
    theirs = normal(sql.sql(oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False)


def test_every_sql_text_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(queries()) - set(oracle_sql()) == {
        "ranker_train_summary", "ranker_learning_curve", "ranker_scores", "end_to_end_run", "metrics_training",
    }


def test_entry(spark):
    assert entry_points.entry(spark).count() == 7617


def test_ranker_queries(spark):
    known = queries()
    assert known["ranker_learning_curve"](spark, SMALL).count() == known["ranker_train_summary"](spark, SMALL).first()["rounds"]
    assert known["ranker_scores"](spark, SMALL).count() == 7617
