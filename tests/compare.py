"""Run a query and its oracle on the same tables and compare every value."""

from __future__ import annotations

import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            source = f"{path}/*.parquet" if os.path.isdir(path) else path
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{source}'")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, value)
    if isinstance(value, int):
        return (2, value)
    if isinstance(value, float):
        return (3, "nan" if math.isnan(value) else repr(value))
    if isinstance(value, Decimal):
        return (4, str(value))
    if isinstance(value, datetime):
        return (5, value.isoformat())
    if isinstance(value, date):
        return (6, value.isoformat())
    return (7, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql) -> str | None:
    """None when columns, row count and all values agree; else what differs."""
    result = con.execute(sql)
    want_columns = [c[0] for c in result.description]
    want = rows_of(want_columns, result.fetchall())
    if sorted(want_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(want_columns)}"
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got == want:
        return None if got else "no rows"
    extra = [r for r in got if r not in set(want)][:2]
    missing = [r for r in want if r not in set(got)][:2]
    return (
        f"{len(got)} vs {len(want)} rows on {sorted(want_columns)}\n  spark: "
        f"{[[v[1] for v in r] for r in extra]}\n  sql:   {[[v[1] for v in r] for r in missing]}"
    )
