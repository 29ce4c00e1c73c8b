"""Runs a query and its reference SQL on one data set and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((v is None, type(v).__name__ if not isinstance(v, (int, float)) else "n", repr(v) if v is None else v) for v in row)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=lambda t: repr(_key(t)))


def differences(df, con, sql: str) -> list[str]:
    """What differs, empty when the results are equal."""
    cur = con.execute(sql)
    theirs_cols = [c[0] for c in cur.description]
    theirs = _rows(theirs_cols, cur.fetchall())
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    out = []
    if sorted(df.columns) != sorted(theirs_cols):
        out.append(f"columns {sorted(df.columns)} != {sorted(theirs_cols)}")
    if len(ours) != len(theirs):
        out.append(f"{len(ours)} rows != {len(theirs)}")
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b or repr(a).count("-0.0,") != repr(b).count("-0.0,")]
    if bad:
        out.append(f"{len(bad)} rows differ, first {bad[0]}")
    return out
