"""Run registered queries and compare them with their SQL, row by row."""

from __future__ import annotations

import collections
import decimal
import pathlib

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = pathlib.Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    return value


def compare(df, con, sql: str) -> str | None:
    """None if both give the same columns and the same bag of rows, else what differs."""
    relation = con.sql(sql)
    ours, theirs = sorted(df.columns), sorted(relation.columns)
    if ours != theirs:
        return f"columns {ours} != {theirs}"
    left = collections.Counter(tuple(map(_plain, r)) for r in df.select(*ours).collect())
    order = ", ".join(f'"{c}"' for c in ours)
    right = collections.Counter(tuple(map(_plain, r)) for r in relation.project(order).fetchall())
    if left == right:
        return None
    only_l, only_r = list((left - right).items()), list((right - left).items())
    return f"{sum(left.values())} rows != {sum(right.values())} rows; ours {only_l[:2]} theirs {only_r[:2]}"
