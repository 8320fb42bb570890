"""Every registered query with a SQL twin matches DuckDB on sf0.001."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from sf_paths import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 4)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return v


def _rows(df):
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return cols, sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.sql(SQL[name]).df()
    c1, r1 = _rows(got)
    c2, r2 = _rows(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
