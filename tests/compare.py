"""Compare a Spark result with DuckDB's answer to the query's SQL, order ignored."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

from strandline.tables import TABLES


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{files}')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return ("n", float(v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("n", "nan" if isinstance(v, float) and math.isnan(v) else v)
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    return ("x", str(v)) if v is not None else ("", "")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in map(tuple, rows))


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {df.columns} != {columns}"
    found = rows_of(df.columns, df.collect())
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    for a, b in zip(found, expected):
        if a != b:
            return f"{a} != {b}"
    return None
