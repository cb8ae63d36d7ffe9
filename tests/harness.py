"""Compare a query with its DuckDB oracle on the given tables."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{root}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, (int, float)):
        value = float(value)
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(normal(row[n]) for n in names) for row in df.collect())


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(normal(row[i]) for i in order) for row in cur.fetchall())


def difference(df, con, sql) -> str | None:
    """None when the results agree, otherwise a short description."""
    names, left = spark_rows(df)
    other, right = duck_rows(con, sql)
    if names != other:
        return f"columns differ: {set(names) ^ set(other)}"
    if left == right:
        return None
    a, b = list((left - right).elements()), list((right - left).elements())
    lines = [f"rows {sum(left.values())} vs {sum(right.values())}; "
             f"{len(a)} only in spark, {len(b)} only in oracle"]
    if a and b:
        x = sorted(a, key=repr)[0]
        y = max(b, key=lambda r: sum(p == q for p, q in zip(r, x)))
        lines += [f"  {n}: {p!r} vs {q!r}" for n, p, q in zip(names, x, y) if p != q]
    elif a or b:
        lines.append("  " + repr(dict(zip(names, (a or b)[0]))))
    return "\n".join(lines)
