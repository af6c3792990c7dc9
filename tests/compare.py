"""Running registered queries and their SQL side by side."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else (None if math.isnan(value) else value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, dt.date) else value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(frame, con, sql: str) -> str | None:
    """None when both give the same bag of rows and the same column names."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} and {sorted(names)}"
    expected, actual = bag(names, result.fetchall()), bag(frame.columns, frame.collect())
    if expected == actual:
        return None
    missing, extra = expected - actual, actual - expected
    return (
        f"{sum(actual.values())} rows for {sum(expected.values())}; columns {sorted(names)}; "
        f"missing {list(missing)[:3]}; extra {list(extra)[:3]}"
    )
