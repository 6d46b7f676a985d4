"""Queries with SQL against DuckDB, and the list of registered queries."""

import duckdb
import pytest

from ingot.llm.queries import QUERIES, SQL

D = "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_its_sql(spark, duck, key):
    df = QUERIES[key](spark, D)
    cur = duck.execute(SQL[key])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted((tuple(r) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=repr) == want and want


def test_one_query_for_each_operator():
    assert [k.split("_")[0] for k in sorted(QUERIES, key=lambda k: (len(k.split("_")[0]), k))] == [f"op{n}" for n in range(1, 14)] + ["pipeline"]
