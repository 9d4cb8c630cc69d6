"""Runs a query and its SQL side by side and compares the rows without regard to order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, float) and math.isnan(v):
        return (1, "nan")
    return (2, type(v).__name__, repr(v))


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def differences(df, con, sql) -> str | None:
    """None if both sides agree, else what differs."""
    got_cols, got = table(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want_cols, want = table(cols, cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0]}"
    return None
