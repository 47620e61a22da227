"""Topic streams: Kafka on a cluster, folders of text files where there is no broker.

Both give `value` (the message text), `topic` and `arrived` (a timestamp); message streams also `id`. Positions are kept by the
query's checkpoint; the starting position applies to its first run only.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EARLIEST, LATEST = "earliest", "latest"
Offsets = Mapping[int, int]


def starting_offsets(topic: str, start: str | Offsets) -> str:
    """`earliest`, `latest`, or a JSON map from partition to offset."""
    if isinstance(start, str):
        if start not in (EARLIEST, LATEST):
            raise ValueError(f"unknown starting position {start!r}")
        return start
    return json.dumps({topic: {str(p): o for p, o in sorted(start.items())}})


def kafka_options(
    servers: str, topic: str, start: str | Offsets = LATEST, max_rows_per_batch: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets(topic, start),
        "failOnDataLoss": "true",
    }
    if max_rows_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_rows_per_batch)
    return options


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    start: str | Offsets = LATEST,
    max_rows_per_batch: int | None = None,
) -> DataFrame:
    """Needs the spark-sql-kafka package on the cluster."""
    reader = spark.readStream.format("kafka")
    loaded = reader.options(**kafka_options(servers, topic, start, max_rows_per_batch)).load()
    return loaded.select(
        F.col("value").cast("string").alias("value"), "topic", F.col("timestamp").alias("arrived")
    )


def kafka_message_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    start: str | Offsets = LATEST,
    max_rows_per_batch: int | None = None,
) -> DataFrame:
    """`kafka_stream` with the `id` that the writer gave a message; without one, its own position."""
    options = kafka_options(servers, topic, start, max_rows_per_batch) | {"includeHeaders": "true"}
    return with_message_ids(spark.readStream.format("kafka").options(**options).load())


def with_message_ids(loaded: DataFrame) -> DataFrame:
    """(value, topic, arrived, id) of Kafka rows that were read with their headers."""
    given = F.filter("headers", lambda h: h["key"] == "id")
    own = F.concat_ws(":", F.lit("@"), "partition", "offset")
    return loaded.select(
        F.col("value").cast("string").alias("value"), "topic", F.col("timestamp").alias("arrived"),
        F.coalesce(F.try_element_at(given, F.lit(-1))["value"].cast("string"), own).alias("id"),
    )


def message_stream(
    spark: SparkSession, path: str, topic: str, max_files_per_batch: int | None = None
) -> DataFrame:
    """The messages (value, topic, arrived, id) in the Parquet files of a topic's folder. A message that has no
    id is known by its file and row."""
    reader = spark.readStream.schema("id string, value string")
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    own = F.concat_ws(":", F.lit("@"), F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return reader.parquet(path).select(
        "value", F.lit(topic).alias("topic"), F.col("_metadata.file_modification_time").alias("arrived"),
        F.coalesce("id", own).alias("id"),
    )


def once(messages: DataFrame, within: str) -> DataFrame:
    """Messages without those that were sent again within that time: an at-least-once writer repeats the
    messages of a batch that it replays, with the ids they had. The ids of that span are kept as state."""
    return messages.withWatermark("arrived", within).dropDuplicatesWithinWatermark(["topic", "id"])


def kafka_range_options(servers: str, topic: str, from_ms: int, to_ms: int) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingTimestamp": str(from_ms),
        "endingTimestamp": str(to_ms),
        # A partition without messages after from_ms is empty, not an error.
        "startingOffsetsByTimestampStrategy": "latest",
    }


def kafka_range(
    spark: SparkSession, servers: str, topic: str, from_ms: int, to_ms: int
) -> DataFrame:
    """Batch read of the messages that arrived in [from_ms, to_ms)."""
    options = kafka_range_options(servers, topic, from_ms, to_ms)
    return spark.read.format("kafka").options(**options).load().select(
        F.col("value").cast("string").alias("value"), "topic", F.col("timestamp").alias("arrived")
    )


def folder_stream(
    spark: SparkSession, path: str, topic: str, max_files_per_batch: int | None = None
) -> DataFrame:
    """One message per line; a message arrives when its file is written."""
    reader = spark.readStream.format("text")
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(path).select(
        "value", F.lit(topic).alias("topic"), F.col("_metadata.file_modification_time")
        .alias("arrived")
    )


def saved_offsets(rows: DataFrame, group: str, topic: str) -> DataFrame:
    """(partition_id, offset): last stored position per partition of a group and topic.

    `rows` has group_id, topic, partition_id and offset, possibly several per key; offsets only
    grow, so the largest is the last.
    """
    mine = rows.filter((F.col("group_id") == group) & (F.col("topic") == topic))
    return mine.groupBy("partition_id").agg(F.max("offset").alias("offset"))
