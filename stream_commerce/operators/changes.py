"""Database row changes: routing to topics and latest state of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stream_commerce.operators.latest import last_per_key
from stream_commerce.schemas import ORDER_DETAIL_TOPIC, ORDER_INFO_TOPIC

# What is taken from each table.
ROW_KIND = "ROWDATA"
USER_STATE = "user_info"
WEEK_MS = 7 * 24 * 60 * 60 * 1000


def target_of() -> Column:
    """Topic or state table of a change; null for changes nobody reads."""
    inserted = F.col("op") == "INSERT"
    return (
        F.when((F.col("table") == "order_info") & inserted, ORDER_INFO_TOPIC)
        .when((F.col("table") == "order_detail") & inserted, ORDER_DETAIL_TOPIC)
        .when((F.col("table") == "user_info") & F.col("op").isin("INSERT", "UPDATE"), USER_STATE)
    )


def after_images(changes: DataFrame) -> DataFrame:
    """One row per changed row: target, seq, position in the statement, ts and the after-image.

    Transaction markers and unread tables are filtered before any array is touched.
    """
    wanted = changes.filter((F.col("kind") == ROW_KIND) & target_of().isNotNull())
    return wanted.select(
        target_of().alias("target"), "seq", "ts", F.posexplode("rows").alias("pos", "after")
    )


def after_json(after: Column) -> Column:
    """JSON object of an after-image; every value is text and null columns are left out. A column
    that is named twice has its last value."""
    given = F.filter(after, lambda c: c["value"].isNotNull())
    names = F.array_distinct(F.transform(given, lambda c: c["name"]))
    last = F.transform(names, lambda n: F.element_at(F.filter(given, lambda c: c["name"] == n), -1)["value"])
    return F.to_json(F.map_from_arrays(names, last))


def after_value(after: Column, name: str) -> Column:
    """The last value of that name; null if there is none."""
    return F.try_element_at(F.filter(after, lambda c: c["name"] == name), F.lit(-1))["value"]


def route_changes(changes: DataFrame) -> DataFrame:
    """(target, seq, pos, value) for every changed row that is read by a topic or state table."""
    return after_images(changes).select(
        "target", "seq", "pos", after_json(F.col("after")).alias("value")
    )


def topic_rows(changes: DataFrame) -> DataFrame:
    """(topic, value) of the rows that go to topics."""
    return messages(changes).select("topic", "value")


def messages(changes: DataFrame) -> DataFrame:
    """(topic, id, value) of the rows that go to topics. `id` is the row's place in the change log, so a row
    that is sent again has the same one."""
    routed = route_changes(changes).filter(F.col("target") != USER_STATE)
    return routed.select(F.col("target").alias("topic"), F.concat_ws(":", "seq", "pos").alias("id"), "value")


def order_inserts(changes: DataFrame) -> DataFrame:
    """(topic, value) of inserted orders only."""
    return topic_rows(changes).filter(F.col("topic") == ORDER_INFO_TOPIC)


def user_rows(changes: DataFrame) -> DataFrame:
    """(id, seq, pos, ts, value) of inserted and updated users."""
    images = after_images(changes).filter(F.col("target") == USER_STATE)
    return images.select(
        after_value(F.col("after"), "id").alias("id"), "seq", "pos", "ts",
        after_json(F.col("after")).alias("value"),
    )


def user_columns(changes: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns (id among them), seq, pos and ts of inserted and updated users."""
    images = after_images(changes).filter(F.col("target") == USER_STATE)
    return images.select(*[after_value(F.col("after"), n).alias(n) for n in names], "seq", "pos", "ts")


def latest_users(users: DataFrame) -> DataFrame:
    """Last written row per user."""
    return last_per_key(users, ["id"], ["seq", "pos"])


def unexpired(users: DataFrame, now_ms: Column | int, ttl_ms: int = WEEK_MS) -> DataFrame:
    """Users written within `ttl_ms` before `now_ms`; each write starts a new term."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    return users.filter(F.col("ts") > now - F.lit(ttl_ms))
