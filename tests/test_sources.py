from __future__ import annotations

import json

import pytest

from stream_commerce.operators.joins import null_safe_join
from stream_commerce.operators.latest import first_per_key, last_per_key
from stream_commerce.sources import dimensions, topics
from stream_commerce.streaming import sinks


def test_topic_options():
    options = topics.kafka_options("h:9092", "base_log")
    assert options["startingOffsets"] == "latest" and options["subscribe"] == "base_log"
    options = topics.kafka_options("h:9092", "t", {1: 7, 0: 5}, 1000)
    assert options["startingOffsets"] == '{"t": {"0": 5, "1": 7}}'
    assert options["maxOffsetsPerTrigger"] == "1000"
    with pytest.raises(ValueError):
        topics.starting_offsets("t", "middle")
    options = topics.kafka_range_options("h:9092", "t", 10, 20)
    assert (options["startingTimestamp"], options["endingTimestamp"]) == ("10", "20")


def test_saved_offsets_seed_a_stream(spark):
    rows = spark.createDataFrame(
        [("g", "t", 0, 5), ("g", "t", 0, 9), ("g", "t", 1, 3), ("g", "other", 0, 99), ("h", "t", 0, 88)],
        "group_id string, topic string, partition_id int, offset bigint",
    )
    found = {r.partition_id: r.offset for r in topics.saved_offsets(rows, "g", "t").collect()}
    assert found == {0: 9, 1: 3}
    assert topics.starting_offsets("t", found) == '{"t": {"0": 9, "1": 3}}'


def test_jdbc_options():
    options = dimensions.jdbc_options("jdbc:x", "base_province", "u", "p", "d")
    assert options["dbtable"] == "base_province" and options["driver"] == "d"


def test_producer_is_idempotent():
    assert sinks.PRODUCER_OPTIONS["kafka.enable.idempotence"] == "true"
    assert sinks.PRODUCER_OPTIONS["kafka.acks"] == "all"


def test_null_safe_join_of_a_table_with_itself(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    doubled = df.selectExpr("k", "v * 2 as w")
    assert {tuple(r) for r in null_safe_join(df, doubled, ["k"]).collect()} == {(None, 1, 2), ("a", 2, 4)}
    assert null_safe_join(df, df.filter("k is null"), ["k"], "left_semi").columns == ["k", "v"]


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "w"), (None, 5, "z")], "k string, n int, t string"
    )
    assert {tuple(r) for r in first_per_key(df, ["k"], ["n"]).collect()} == {("a", 1, "w"), (None, 5, "z")}
    assert {tuple(r) for r in last_per_key(df, ["k"], ["n"]).collect()} == {("a", 2, "x"), (None, 5, "z")}


def test_console_reads_each_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("hello",)], "value string").write.text(source)
    query = sinks.console_writer(spark.readStream.text(source)).trigger(availableNow=True).start()
    query.awaitTermination()
    progress = json.loads(query.lastProgress.json)
    assert "ConsoleTable" in progress["sink"]["description"] and progress["numInputRows"] == 1


def test_work_folder_comes_from_the_session(spark, tmp_path):
    from stream_commerce.config import new_work_dir

    assert "/x-" in new_work_dir(spark, "x")

    class Conf:
        def get(self, key, default=None):
            assert key == "spark.checkpoint.dir"
            return "hdfs:///shared/"

    class Session:
        conf = Conf()

    assert new_work_dir(Session(), "x").startswith("hdfs:///shared/x-")
