"""Every query with oracle SQL gives DuckDB's rows on the smallest tables."""

import duckdb
import pytest

from strandplan.plans.catalogue import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    rows = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert rows == sorted(map(repr, want.project(", ".join(f'"{c}"' for c in columns)).fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).columns
