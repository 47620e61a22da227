"""Split raw application logs into start records and action records.

A raw log is one JSON object: `common`, optional `start`, optional `page`, optional `actions`,
optional `err`, and `ts`. One pass parses each log once and emits every record it yields, so both
topics can be written by a single query without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stream_commerce.functions.maps import VARIANT_MAP, merge_maps, with_json
from stream_commerce.functions.records import CORRUPT, parse_json
from stream_commerce.schemas import ACTION_TOPIC, START_TOPIC

ENVELOPE = (
    f"common {VARIANT_MAP}, start {VARIANT_MAP}, page {VARIANT_MAP}, "
    f"actions array<{VARIANT_MAP}>, err variant, ts string"
)

START, ACTION, DROPPED = "start", "action", "dropped"


def route_of() -> Column:
    """Where a parsed log goes. `err` may be a JSON null: its presence alone drops the log."""
    usable = F.col("err").isNull() & F.col("common").isNotNull()
    return (
        F.when(usable & F.col("start").isNotNull(), START)
        .when(usable & F.col("actions").isNotNull() & F.col("page").isNotNull(), ACTION)
        .otherwise(DROPPED)
    )


def parse_logs(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parsed envelope plus its `route`."""
    return parse_json(raw, ENVELOPE, value).withColumn("route", route_of())


def divert(raw: DataFrame, value: str = "value", only: str | None = None) -> DataFrame:
    """Rows (topic, value): one per start log and one per entry of `actions`.

    A start record is common, then the outer `ts`, then the start fields; an action record is
    common, then page, then the action. Later parts replace earlier keys, and each action is merged
    on its own. `only` keeps one route.
    """
    ts = F.create_map(F.lit("ts"), F.col("ts").try_cast("bigint").cast("variant"))
    # Topic, what the records of a log share besides common, and what each of them adds.
    parts = {
        START: (START_TOPIC, ts, F.array("start")),
        ACTION: (ACTION_TOPIC, F.col("page"), F.col("actions")),
    }
    if only is not None:
        parts = {only: parts[only]}
    topic = second = own = F
    for route, (name, shared, overlays) in parts.items():
        hit = F.col("route") == route
        topic, second, own = topic.when(hit, name), second.when(hit, shared), own.when(hit, overlays)
    # The outer generator keeps Catalyst from copying its input into a size check below it; logs
    # that yield nothing are removed right after.
    merged = merge_maps(F.col("common"), F.col("second"), F.col("own"))
    records = (
        parse_logs(raw, value)
        .select(
            topic.alias("topic"), "common", second.alias("second"), F.explode_outer(own).alias("own")
        )
        .filter(F.col("own").isNotNull())
        .select("topic", merged.alias("entries"))
    )
    return with_json(records, "entries", "value").select("topic", "value")


# For the route alone it matters which parts are there, not what is in them.
SLIM = "common struct<>, start struct<>, page struct<>, actions array<struct<>>, err variant"


def unreadable_logs(raw: DataFrame, value: str = "value") -> DataFrame:
    """(value): the texts that are no JSON object of a log. Logs that are read but dropped by their
    route (`err`, or neither start nor actions) are not among them."""
    kept = raw.select(F.col(value).alias("value"), F.col(value).alias("_text"))
    return parse_json(kept, SLIM, "_text").filter(F.col(CORRUPT).isNotNull()).select("value")


def route_counts(raw: DataFrame, value: str = "value") -> DataFrame:
    """Number of raw logs per route, the dropped ones included."""
    routes = parse_json(raw, SLIM, value).select(route_of().alias("route"))
    return routes.groupBy("route").agg(F.count(F.lit(1)).alias("logs"))
