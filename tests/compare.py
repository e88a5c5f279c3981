"""Runs a query on Spark and its SQL on DuckDB and compares the rows as multisets."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 12)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_cell(r[i]) for i in order] for r in rows), key=repr)


def compare(df, con, sql) -> str | None:
    """None when equal, otherwise a short description of the difference."""
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    expected = rows_of(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    kinds = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    types = dict(zip(rel.columns, [kinds.get(str(t), str(t)) for t in rel.types]))
    if dict(df.dtypes) != types:
        return f"types {dict(df.dtypes)} != {types}"
    if got != expected:
        extra = [r for r in got if r not in expected][:3] if len(got) < 5000 else got[:2]
        return f"{len(got)} rows, expected {len(expected)}; e.g. {extra} / {expected[:2]}"
    return None
