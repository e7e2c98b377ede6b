"""Run a query and its SQL on the same tables and compare them as unordered rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(
        tuple((type(row[i]).__name__, row[i]) for i in order) for row in rows
    )


def differences(con, df, sql):
    """Rows only in Spark, rows only in SQL; empty when equal, types included."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names), (df.columns, names)
    expected = _rows(names, result.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    return got - expected, expected - got
