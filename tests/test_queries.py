"""Every query of the engine runs; those with SQL give DuckDB's rows, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import corpusmill.plans.more_queries  # noqa: F401  adds its queries
from corpusmill.plans.queries import QUERIES, SQL

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{TABLES}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f).removesuffix('.parquet')} AS SELECT * FROM '{f}'")
    return con


def near(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, TABLES)
    columns = sorted(df.columns)
    got = [tuple(near(r[c]) for c in columns) for r in df.collect()]
    asked = duck.execute(SQL[name])
    places = [[x[0] for x in asked.description].index(c) for c in columns]
    assert len(places) == len(asked.description)
    assert sorted(map(repr, got)) == sorted(repr(tuple(near(r[i]) for i in places)) for r in asked.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, TABLES).count() > 0 or name == "near_duplicate_pairs"
