"""Run a registered query and its SQL on the same tables and compare them."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return f"{type(value).__name__}:{value}"


def normalise(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), normalise(df.columns, df.collect())


def duckdb_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), normalise(columns, cursor.fetchall())
