"""Join rows of one key whose times lie close together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stream_commerce.functions.times import floor_div


def interval_pairs(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    width: int,
) -> DataFrame:
    """Inner pairs with equal `keys` and |left_time - right_time| <= width (same integer unit).

    Time is cut into cells of `width`; a left row is sent to its own cell and both neighbours, and
    the join runs on (keys, cell). A key with very many rows is thereby spread over its cells, and
    the pairs compared stay within three widths instead of all rows of the key. The result has all
    columns of both sides; names other than the keys must differ.
    """
    own = floor_div(F.col(left_time), width)
    spread = left.withColumn("_cell", F.explode(F.array(own - 1, own, own + 1)))
    placed = right.withColumn("_cell", floor_div(F.col(right_time), width))
    near = F.abs(F.col(left_time) - F.col(right_time)) <= F.lit(width)
    return spread.join(placed, [*keys, "_cell"]).filter(near).drop("_cell")


def without_partner(
    rows: DataFrame,
    others: DataFrame,
    keys: Sequence[str],
    rows_time: str,
    others_time: str,
    width: int,
) -> DataFrame:
    """Rows of `rows` that `interval_pairs` would leave unpaired.

    Whether some partner exists needs only the first and last time per (keys, cell) of `others`,
    which is aggregated map-side: a key with very many partners never has to be in one place. The
    few cells are sent to their neighbours, the rows stay single, and Spark can split a cell that
    holds very many rows because a shuffle feeds each side of the join directly.
    """
    cells = others.groupBy(
        *keys, floor_div(F.col(others_time), width).alias("_at")
    ).agg(F.min(others_time).alias("_first"), F.max(others_time).alias("_last"))
    at = F.col("_at")
    near = cells.select(
        *[F.col(k).alias(f"_{k}") for k in keys], "_first", "_last",
        F.explode(F.array(at - 1, at, at + 1)).alias("_near"),
    )
    placed = rows.withColumn("_cell", floor_div(F.col(rows_time), width))
    # The whole own cell is in reach, the earlier one from its end and the later from its start.
    condition = (
        (F.col("_cell") == F.col("_near"))
        & (F.col("_last") >= F.col(rows_time) - F.lit(width))
        & (F.col("_first") <= F.col(rows_time) + F.lit(width))
    )
    for key in keys:
        condition = condition & (F.col(key) == F.col(f"_{key}"))
    return placed.join(near, condition, "left_anti").drop("_cell")
