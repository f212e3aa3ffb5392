"""Runs registered queries beside their SQL twins and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os


def connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, bool):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    return v


def rows_of_sql(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str):
    """(ok, message)"""
    df = fn(spark, sf_dir)
    names, rows = normal(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return True, f"{len(rows)} rows (no SQL)"
    want_names, want = normal(*rows_of_sql(con, sql))
    if names != want_names:
        return False, f"columns {names} != {want_names}"
    if rows != want:
        only = [r for r in rows if r not in set(want)][:3]
        miss = [r for r in want if r not in set(rows)][:3]
        return False, f"{len(rows)} rows vs {len(want)}; only ours {only}; only sql {miss}"
    return True, f"{len(rows)} rows"
