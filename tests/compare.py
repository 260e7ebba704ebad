"""Run a registered query in Spark and its SQL counterpart in DuckDB, and compare rows."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    text = df.apply(lambda c: c.map(lambda v: "~" if v is None or v is pd.NA or v != v else repr(v)))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def _plain(rows, columns) -> pd.DataFrame:
    return pd.DataFrame([tuple(r) for r in rows], columns=columns, dtype=object)


def differences(df, con, sql: str) -> str | None:
    """None when both sides hold the same rows, else a short account."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = _plain(cur.fetchall(), names)
    ours = _plain(df.collect(), df.columns)
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    a, b = canonical(ours), canonical(theirs)
    if a.equals(b):
        return None
    bad = (a != b).any(axis=1)
    cols = [c for c in a.columns if (a[c] != b[c]).any()]
    return (
        f"{int(bad.sum())} of {len(a)} rows differ in {cols}\n"
        f"{a[bad].head(3).to_string()}\n{b[bad].head(3).to_string()}"
    )
