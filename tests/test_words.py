from __future__ import annotations

import pytest

from stream_commerce.operators import words
from stream_commerce.sources.topics import folder_stream
from stream_commerce.streaming import jobs


@pytest.mark.parametrize("text, expected", [
    ("a b a", ["a", "b", "a"]), ("a  b ", ["a", "", "b"]), (" a", ["", "a"]), ("", [""]), ("  ", []),
    ("a\tb\nc d", ["a\tb\nc", "d"]), (None, []),
])
def test_split_at_single_spaces(spark, text, expected):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(text,)], "value string")
    assert [r[0] for r in df.select(F.explode(words.words_of(F.col("value")))).collect()] == expected


@pytest.mark.parametrize("how, expected", [
    ("inner", {("b", 1, 2)}), ("left", {("a", 2, None), ("b", 1, 2)}),
    ("right", {("b", 1, 2), ("c", None, 1)}), ("full", {("a", 2, None), ("b", 1, 2), ("c", None, 1)}),
])
def test_joins(spark, how, expected):
    left = words.word_counts(spark.createDataFrame([("a b a",)], "value string"))
    right = words.word_counts(spark.createDataFrame([("b b",), ("c",)], "value string"))
    assert {tuple(r) for r in words.join_counts(left, right, how).collect()} == expected


def test_running_counts_and_join_of_two_streams(spark, feed, tmp_path):
    first = feed("a b", "a", name="first")
    feed("b", name="first")
    second = feed("b c", name="second")
    tables = []
    for name, path in (("first", first), ("second", second)):
        table = jobs.word_table(str(tmp_path / f"{name}-t"))
        stream = folder_stream(spark, path, name, max_files_per_batch=1)
        jobs.run_word_counts(
            stream, table, str(tmp_path / f"{name}-c"), jobs.UNTIL_DRAINED
        ).awaitTermination()
        tables.append(table)
    left, right = (jobs.word_view(spark, t) for t in tables)
    assert {tuple(r) for r in left.collect()} == {("a", 2), ("b", 2)}
    assert {tuple(r) for r in words.join_counts(left, right, "full").collect()} == {
        ("a", 2, None), ("b", 2, 1), ("c", None, 1),
    }


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_side_by_side_equals_the_join(spark, how):
    left, right = [("a b a",), ("",)], [("b b",), ("c",)]
    tagged = spark.createDataFrame(
        [("left", t) for t, in left] + [("right", t) for t, in right], "side string, value string"
    )
    joined = words.join_counts(
        words.word_counts(spark.createDataFrame(left, "value string")),
        words.word_counts(spark.createDataFrame(right, "value string")), how,
    )
    assert {tuple(r) for r in words.side_by_side(tagged, how).collect()} == {
        tuple(r) for r in joined.collect()
    }


def test_each_batch_joins_its_own_words(spark, feed, tmp_path):
    first, second = feed("a b", name="first"), feed("b c", name="second")
    feed("c", name="first"), feed("c c", name="second")
    table = jobs.word_join_table(str(tmp_path / "t"))
    jobs.run_word_joins(
        folder_stream(spark, first, "f", 1), folder_stream(spark, second, "s", 1), "inner", table,
        str(tmp_path / "c"), jobs.UNTIL_DRAINED,
    ).awaitTermination()
    assert {tuple(r) for r in table.read(spark).collect()} == {("b", 1, 1, 0), ("c", 1, 2, 1)}
