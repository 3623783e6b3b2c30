"""Runs a query and its SQL check on the same files and compares all rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return repr(value)
    if isinstance(value, int):
        return repr(float(value))
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return repr(value)


def canonical(columns, rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, sql: str, con) -> str | None:
    """None when both sides hold the same rows, else the first difference."""
    got = canonical(df.columns, df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = canonical(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got == want:
        return None
    extra, missing = set(got) - set(want), set(want) - set(got)
    return f"{len(got)} rows vs {len(want)}; only here {sorted(extra)[:3]}; only there {sorted(missing)[:3]}"
