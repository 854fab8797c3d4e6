"""Every registered query against its DuckDB twin on the smallest tables."""

import math

import duckdb
import pytest

from panelforge.plans import load_all
from panelforge.sources.tables import TABLES

QUERIES = load_all()
SLOW = {"m8_model_selection"}


def _canon(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat().removesuffix("T00:00:00")  # a midnight and its date are the same
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_matches_sql(spark, sf, con, name):
    q = QUERIES[name]
    df = q.build(spark, sf)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(q.sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _digest(df.columns, rows) == _digest(ocols, res.fetchall())


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if not q.sql and n not in SLOW))
def test_rows_only_queries_run(spark, sf, name):
    assert QUERIES[name].build(spark, sf).count() >= 0
