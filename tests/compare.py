"""Run registered queries and compare their rows with their SQL."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same rows, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    found = rows_of(spark_df.columns, spark_df.collect())
    if not expected:
        return "the SQL returns no rows"
    if found == expected:
        return None
    missing, extra = expected - found, found - expected
    return (
        f"{sum(found.values())} rows, expected {sum(expected.values())}; "
        f"missing {list(missing)[:2]}, extra {list(extra)[:2]}"
    )
