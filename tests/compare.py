"""Spark results against DuckDB on the same tables.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def tidy(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in one order, values as text."""
    df = df[sorted(df.columns)].map(lambda v: "" if v is None or v != v else repr(v.item() if hasattr(v, "item") else v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    kinds = {c: (got[c].dtype.kind, want[c].dtype.kind) for c in got.columns if got[c].dtype.kind != want[c].dtype.kind}
    if kinds:
        return f"types {kinds}"
    got, want = tidy(got), tidy(want)
    unlike = (got != want).any(axis=1)
    if unlike.any():
        return f"{unlike.sum()} unlike rows\n{got[unlike].head(3)}\n{want[unlike].head(3)}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con, sql = local_session(), connect(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if name not in sql or names and name not in names:
            continue
        start = time.time()
        got = query(spark, sf_dir).toPandas()
        took = time.time() - start
        problem = difference(got, con.sql(sql[name]).df())
        bad += problem is not None
        print(f"{name:24} {len(got):9} rows {took:6.2f} s  {problem or 'same'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
