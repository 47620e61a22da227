"""Join helper: keys that may be null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which a null key matches a null key.

    Returns the columns of `left` followed by the non-key columns of `right`. The keys of `right`
    are renamed first, so both sides may come from the same table.
    """
    theirs = {k: f"_right_{k}" for k in keys}
    other = right.select([F.col(c).alias(theirs.get(c, c)) for c in right.columns])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(theirs[k])) for k in keys])
    return left.join(other, same, how).drop(*theirs.values())
