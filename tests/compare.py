"""Order-independent comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _kind(value) -> str:
    return "none" if value is None else type(value).__name__


def _clean(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def difference(columns, rows, other_columns, other_rows) -> str | None:
    """What differs between two results, or None."""
    if sorted(columns) != sorted(other_columns):
        return f"columns {sorted(columns)} != {sorted(other_columns)}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows != {len(other_rows)} rows"
    names = sorted(columns)
    left = sorted(_pick(columns, names, rows), key=repr)
    right = sorted(_pick(other_columns, names, other_rows), key=repr)
    for a, b in zip(left, right):
        if a != b or [_kind(v) for v in a] != [_kind(v) for v in b]:
            return f"row {dict(zip(names, a))} != {dict(zip(names, b))}"
    return None


def _pick(columns, names, rows):
    at = [columns.index(n) for n in names]
    return [tuple(_clean(r[i]) for i in at) for r in rows]


def check(spark, sf_dir: str, name: str, build, sql: str, con=None) -> str | None:
    df = build(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cursor = (con or connect(sf_dir)).execute(sql)
    columns = [d[0] for d in cursor.description]
    return difference(df.columns, rows, columns, cursor.fetchall())
