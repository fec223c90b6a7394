"""Run a Spark query and its oracle and compare the rows exactly."""

from __future__ import annotations

import datetime as dt
import decimal
import glob

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle_connection(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if glob.glob(path):
            con.execute(f"create view {t} as select * from '{path}'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if v != v else v + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql):
    """None when equal, else a short description of the difference."""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns differ: {sorted(set(df.columns) ^ set(rel.columns))}"
    got = rows_of(df.columns, df.collect())
    want = rows_of(rel.columns, rel.fetchall())
    if len(got) != len(want):
        return f"rows differ: spark {len(got)} oracle {len(want)}"
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        names = sorted(df.columns)
        g, w = bad[0]
        cells = [(n, a, b) for n, a, b in zip(names, g, w) if a != b]
        return f"{len(bad)} of {len(got)} rows differ, first: {cells[:4]}"
    return None
