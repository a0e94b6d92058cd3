"""Row-by-row comparison of a query with its SQL on the same parquet files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def oracle_connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 6) + 0.0)
    if isinstance(value, bool) or value is None:
        return repr(value)
    return f"{type(value).__name__}:{value}"


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in data)


def differences(df, con, sql: str) -> str | None:
    """None when equal, else a short text on what differs."""
    cursor = con.execute(sql)
    want_cols = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    got = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} / {sorted(want_cols)}"
    a, b = rows(df.columns, got), rows(want_cols, want)
    if a == b:
        return None
    extra = [r for r in a if r not in set(b)][:3]
    lacking = [r for r in b if r not in set(a)][:3]
    return f"{len(a)} / {len(b)} rows; only Spark {extra}; only SQL {lacking}"
