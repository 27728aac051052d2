"""The corpus queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from scripts.compare_oracle import TABLES, digest
from tests.conftest import SF_SMALL
from wayfarer.llm import registry

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in {*TABLES, "documents", "benchmark", "pages"}:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    df = registry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, got) == digest(columns, want)
