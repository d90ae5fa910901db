"""Compares a query's rows with its SQL's rows in DuckDB."""
from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


_KINDS = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date"}


def mismatch(df, con, sql) -> str | None:
    """What differs first, or None when names, types and rows agree."""
    result = con.execute(sql)
    kinds = {d[0]: _KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    want = result.fetchall()
    have_kinds = dict(df.dtypes)
    if set(kinds) != set(have_kinds):
        return f"columns {sorted(have_kinds)} against {sorted(kinds)}"
    wrong = {c: (have_kinds[c], kinds[c]) for c in kinds if kinds[c] != have_kinds[c]}
    if wrong:
        return f"types {wrong}"
    left, right = _rows(df.columns, df.collect()), _rows(list(kinds), want)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} against {b}"
    return None
