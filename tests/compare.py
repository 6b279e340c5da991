"""Compare a registered query with its SQL on one scale folder."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v + 0.0:.6g}" if abs(v) < 1e15 else f"{v:.6e}"
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(_norm(x)) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def _kind(v) -> str:
    if isinstance(v, decimal.Decimal):
        return "decimal"
    if isinstance(v, dt.datetime):
        return "datetime"
    return type(v).__name__


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    cols = spark_df.columns
    got = [tuple(r[c] for c in sorted(cols)) for r in spark_df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(cols):
        return f"columns differ: only spark {set(cols) - set(names)}, only sql {set(names) - set(cols)}"
    order = [names.index(c) for c in sorted(names)]
    want = [tuple(r[i] for i in order) for r in cur.fetchall()]
    if len(got) != len(want):
        return f"row counts differ: spark {len(got)}, sql {len(want)}"
    for i, c in enumerate(sorted(cols)):
        kg = {_kind(r[i]) for r in got if r[i] is not None}
        kw = {_kind(r[i]) for r in want if r[i] is not None}
        if kg and kw and kg != kw:
            return f"types differ in {c}: spark {kg}, sql {kw}"
    key = lambda r: [(x is None, str(x)) for x in r]
    a = sorted((tuple(_norm(x) for x in r) for r in got), key=key)
    b = sorted((tuple(_norm(x) for x in r) for r in want), key=key)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(diff)} rows differ, columns {sorted(cols)}; first: spark {diff[0][0]} sql {diff[0][1]}"
    return None
