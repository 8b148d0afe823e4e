"""Compare a query with its SQL, as sorted rows."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    return x


def rows(columns: list[str], found: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[list[tuple], list[tuple], list[str], list[str]]:
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return got, rows(names, result.fetchall()), sorted(df.columns), sorted(names)
