"""Keep one whole row per key: the first or the last in a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    # The order columns lead the struct and all other columns follow, so equal order values are
    # decided by content and a replay keeps the same row. min/max of a struct combine map-side:
    # a hot key leaves each task as a single row.
    rest = [c for c in df.columns if c not in keys and c not in order]
    row: Column = F.struct(*order, *rest)
    picked = df.groupBy(*keys).agg(pick(row).alias("_row"))
    fields = {c: F.col(f"_row.{c}") for c in (*order, *rest)}
    return picked.select(*[fields.get(c, F.col(c)).alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest `order` values per key."""
    return _one_per_key(df, keys, order, F.min)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest `order` values per key: what keyed replace leaves behind."""
    return _one_per_key(df, keys, order, F.max)
