"""Compares a query with its SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path / '*.parquet' if path.is_dir() else path}'")
    return con


def plain(v) -> str:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else "inf" if math.isinf(v) else f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


def same(df, con, sql: str) -> None:
    columns = sorted(df.columns)
    left = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    right = sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())
    assert left == right
