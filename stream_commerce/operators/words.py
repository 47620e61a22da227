"""Word counts and joins of two word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words_of(text: Column) -> Column:
    """Pieces between single spaces. Trailing empty pieces are left out, leading and inner ones
    stay; the empty text is one empty word and a text of spaces only has none."""
    trimmed = F.rtrim(text)
    pieces = F.split(trimmed, " ")
    none = F.array().cast("array<string>")
    return F.when((trimmed == "") & (text != ""), none).otherwise(pieces)


def word_counts(lines: DataFrame, text: str = "value") -> DataFrame:
    words = lines.select(F.explode(words_of(F.col(text))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def fold_counts(partials: DataFrame) -> DataFrame:
    """Add up per-batch counts."""
    return partials.groupBy("word").agg(F.sum("cnt").alias("cnt"))


def join_counts(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """(word, left_cnt, right_cnt) for inner, left, right or full."""
    left = left.select("word", F.col("cnt").alias("left_cnt"))
    right = right.select("word", F.col("cnt").alias("right_cnt"))
    return left.join(right, "word", how)


def side_by_side(tagged: DataFrame, how: str, text: str = "value") -> DataFrame:
    """`join_counts` of two sets of lines that arrive in one frame, told apart by `side`.

    `side` is `left` or `right`. Both counts come from one aggregation, so the lines are read and
    shuffled once; a missing count is null, as in a join.
    """
    words = tagged.select("side", F.explode(words_of(F.col(text))).alias("word"))
    counted = words.groupBy("word").agg(*[
        F.nullif(F.count_if(F.col("side") == side), F.lit(0)).alias(f"{side}_cnt")
        for side in ("left", "right")
    ])
    needed = {"inner": ("left_cnt", "right_cnt"), "left": ("left_cnt",), "right": ("right_cnt",),
              "full": ()}[how]
    return counted.dropna(subset=list(needed)) if needed else counted
