"""Compare a query with its SQL: columns by name, rows in any order."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {p.stem} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, Decimal):
        return float(f"{float(x):.9g}")
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, dict):
        return tuple(sorted((k, plain(v)) for k, v in x.items()))
    return x


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(df, con, sql: str) -> str:
    """Empty if equal, else what differs."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    want, got = rows(names, cur.fetchall()), rows(df.columns, df.collect())
    if want == got:
        return ""
    return f"{sum(got.values())} rows, expected {sum(want.values())}; too many {list((got - want).items())[:4]}; missing {list((want - got).items())[:4]}"
