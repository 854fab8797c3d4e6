"""Corpus queries against their DuckDB twins."""

import duckdb
import pytest

from panelforge.llm.queries import QUERIES
from panelforge.llm.sql import SQL
from panelforge.sources.tables import TABLES


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    found = con.execute(SQL[name])
    cols = [d[0] for d in found.description]
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(cols)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(key, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(key, found.fetchall()))


def test_all_queries():
    import re

    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
