"""Every registered query against its DuckDB SQL on the same parquet tables (sf0.001)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _bag(columns, rows):
    order = sorted(columns)
    idx = [columns.index(c) for c in order]
    return sorted(repr(tuple(_norm(r[i]) for i in idx)) for r in rows)


# the corpus subpackage has its own tests
LAKE_SQL = sorted(set(entry.oracle_sql()) - set(entry._corpus_part("oracle")))
LAKE_QUERIES = set(entry.queries()) - set(entry._corpus_part("queries"))


@pytest.mark.parametrize("name", LAKE_SQL)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _bag(df.columns, rows) == _bag(rel.columns, rel.fetchall())


def test_every_query_has_an_oracle_or_is_documented():
    rows_only = LAKE_QUERIES - set(LAKE_SQL)
    assert rows_only == {"detect_language", "language_report", "open_set_languages"}


def test_rows_only_queries_run(spark):
    for name in ("detect_language", "language_report"):
        assert entry.queries()[name](spark, SF_SMALL).count() > 0


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "hour" and df.count() > 0


def test_language_detection_on_held_out_documents(spark):
    got = entry.queries()["detect_language"](spark, SF_SMALL).where("held_out")
    right = got.where("code = lang").count()
    assert right >= 0.9 * got.count() > 0
