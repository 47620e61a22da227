"""Daily active devices: each device's first start of the day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stream_commerce.functions.records import joined_key, parse_json
from stream_commerce.functions.times import SHANGHAI, date_of, local_time, second_of
from stream_commerce.operators.joins import null_safe_join
from stream_commerce.operators.latest import first_per_key
from stream_commerce.schemas import START_LOG_COLUMNS, START_LOG_SOURCE

KEYS = ["start_date", "mid"]


def parse_starts(values: DataFrame, value: str = "value", zone: str = SHANGHAI) -> DataFrame:
    """Start records with `ts` as a number and the derived id, start_date and start_time.

    Rows without a readable `ts` have no date and are not returned; see `unreadable_texts`.
    """
    parsed = parse_json(values, START_LOG_SOURCE, value)
    return with_start_fields(parsed, zone).filter(F.col("ts").isNotNull())


def unreadable_texts(values: DataFrame, value: str = "value") -> DataFrame:
    """(value): the messages that `parse_starts` leaves out, as they came."""
    kept = values.select(F.col(value).alias("value"), F.col(value).alias("_text"))
    narrow = T.StructType([START_LOG_SOURCE["ts"]])
    return parse_json(kept, narrow, "_text").filter(F.col("ts").try_cast("bigint").isNull()).select("value")


def with_start_fields(starts: DataFrame, zone: str = SHANGHAI) -> DataFrame:
    timed = starts.withColumn("ts", F.col("ts").try_cast("bigint")).withColumn(
        "_local", local_time("ts", zone)
    )
    derived = timed.withColumns({
        "start_date": date_of("_local"),
        "start_time": second_of("_local"),
    }).withColumn("id", joined_key(F.col("start_time"), F.col("mid")))
    return derived.select([c for c in START_LOG_COLUMNS if c in derived.columns])


def first_starts(starts: DataFrame) -> DataFrame:
    """One row per (start_date, mid): the one with the smallest numeric ts."""
    return first_per_key(starts, KEYS, ["ts"])


def with_day(starts: DataFrame) -> DataFrame:
    """`day`: the start_date as a timestamp, the same in any session zone; null beyond the year 9999."""
    days = F.unix_date(F.col("start_date").try_cast("date"))
    return starts.withColumn("day", F.timestamp_seconds(days.cast("bigint") * 86_400))


def ahead(now: Column) -> Column:
    """Whether `day` is after tomorrow: such a clock is wrong and must not move a watermark."""
    return F.coalesce(F.col("day") > now + F.expr("INTERVAL 2 days"), F.lit(True))


def drop_seen(starts: DataFrame, history: DataFrame) -> DataFrame:
    """Rows whose device is not in `history` on that date.

    Both sides need one row per key at most for the join to stay even; `first_starts` gives that
    for the left side, and the history holds one row per device and day.
    """
    return null_safe_join(starts, history.select(*KEYS), KEYS, "left_anti")


def daily_devices(starts: DataFrame) -> DataFrame:
    """Number of distinct devices per start_date (a device without a mid counts as one)."""
    return (
        starts.select(*KEYS).distinct()
        .groupBy("start_date").agg(F.count(F.lit(1)).alias("devices"))
    )
