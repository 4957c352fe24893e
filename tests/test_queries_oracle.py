"""Every registered query with SQL against DuckDB on sf0.001 (the driver
checks sf0.01 the same way); the others must run and return a schema."""
import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()
QUERIES = entry.queries()
CHEAP_ROWS_ONLY = ["stage_tables"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = df.columns
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    cur = con.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == sorted(cols)
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=_key)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "mean", "std", "min", "max", "n"]
    assert df.count() > 0


@pytest.mark.parametrize("name", CHEAP_ROWS_ONLY)
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0
