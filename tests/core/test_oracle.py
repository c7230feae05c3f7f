"""Every registered query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from lakewright.plans import fixture_queries, io_queries, table_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = table_queries.QUERIES | fixture_queries.QUERIES | io_queries.QUERIES
SQL = table_queries.SQL | fixture_queries.SQL | io_queries.SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/*.parquet')" if os.path.isdir(path) else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_is_its_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(repr([plain(row[names.index(c)]) for c in columns]) for row in result.fetchall())
    got = sorted(repr([plain(row[c]) for c in columns]) for row in frame.collect())
    assert got == want
