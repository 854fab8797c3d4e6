"""Compare column types of each query with its DuckDB twin (sf dir arg)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from panelforge.plans import load_all  # noqa: E402
from panelforge.session import build_session  # noqa: E402
from panelforge.sources.tables import TABLES  # noqa: E402

SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT"}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[4]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name, q in sorted(load_all().items()):
        if not q.sql:
            continue
        df = q.build(spark, sf)
        st = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
        rel = con.sql(q.sql)
        dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        diff = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
        if diff:
            bad += 1
            print(name, diff)
    print("type mismatches:", bad)


if __name__ == "__main__":
    main()
