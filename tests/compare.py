"""Comparison of a Spark result with its SQL on DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0 if value else 0.0
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return str(value)


def _kind(name: str) -> str:
    name = name.lower()
    if name.startswith("decimal"):
        return "double"
    return {
        "varchar": "string", "bigint": "bigint", "integer": "int", "int": "int", "double": "double", "date": "date",
        "boolean": "boolean",
    }.get(name, name)


def difference(df, con, sql: str) -> str | None:
    """None when columns, types and rows agree, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: _kind(str(d[1])) for d in cursor.description}
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    wrong = {n: (t, kinds[n]) for n, t in df.dtypes if _kind(t) != kinds[n]}
    order = sorted(names)
    place = [names.index(n) for n in order]
    left = Counter(tuple(_plain(r[n]) for n in order) for r in df.collect())
    right = Counter(tuple(_plain(r[i]) for i in place) for r in expected)
    if left != right:
        only_left, only_right = left - right, right - left
        return (
            f"rows {sum(left.values())} against {sum(right.values())}; {order}; only here {sum(only_left.values())}: "
            f"{list(only_left)[:3]}; only there {sum(only_right.values())}: {list(only_right)[:3]}"
        )
    return f"types {wrong}" if wrong else None
