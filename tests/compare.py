"""Compare a Spark result with a DuckDB result, regardless of row and column order."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb

TESTDATA = os.environ.get("TILLSTAR_TESTDATA", "/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return repr(v) if v != int(v) else repr(int(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat(" ") if isinstance(v, datetime.datetime) else v.isoformat()
    return "NULL" if v is None else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_cols, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    a, b = rows_of(got_cols, got), rows_of(want_cols, want)
    if a == b:
        return None
    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return f"{len(a)} vs {len(b)} rows; spark only {only_a}; duckdb only {only_b}"
