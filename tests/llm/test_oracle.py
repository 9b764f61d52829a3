"""The corpus queries that SQL can express, against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(entry._corpus_part("oracle")))
def test_query_matches_sql(corpus, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry.queries()[name](corpus, SF_SMALL)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    want = sorted((tuple(r) for r in rel.select(*order).fetchall()), key=repr)  # rows may hold nulls
    assert sorted((tuple(r) for r in df.select(*order).collect()), key=repr) == want
