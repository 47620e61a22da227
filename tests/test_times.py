from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from stream_commerce.functions import times

MOMENTS = [0, 1650000000123, 1704067199999, 1704067200000, 563_000_000_000, 1_710_053_999_000]


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_local_parts_do_not_depend_on_the_session_zone(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        at = times.local_time("ms")
        df = spark.createDataFrame([(m,) for m in MOMENTS], "ms bigint").select(
            "ms", times.date_of(at), times.hour_of(at), times.minute_of(at), times.second_of(at)
        )
        found = {r[0]: tuple(r[1:]) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for ms in MOMENTS:
        local = datetime.fromtimestamp(ms // 1000, timezone.utc).astimezone(ZoneInfo("Asia/Shanghai"))
        assert found[ms] == tuple(
            local.strftime(f) for f in ("%Y-%m-%d", "%H", "%Y-%m-%dT%H:%M", "%Y-%m-%dT%H:%M:%S")
        )


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_epoch_does_not_depend_on_the_session_zone(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        texts = ["2024-03-10 02:30:00.000001", "2024-07-01 00:00:00", "1969-12-31 23:59:59.9995"]
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(
            F.col("t").cast("timestamp_ntz").alias("t")
        )
        found = [tuple(r) for r in df.select(times.epoch_us("t"), times.epoch_ms("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [
        (1710037800000001, 1710037800000), (1719792000000000, 1719792000000), (-500, -1),
    ]


def test_floor_div(spark):
    df = spark.createDataFrame([(-1,), (0,), (299,), (300,), (2**60 + 1,)], "v bigint")
    assert [r[0] for r in df.select(times.floor_div(F.col("v"), 300)).collect()] == [
        -1, 0, 0, 1, (2**60 + 1) // 300]


@pytest.mark.parametrize("text, ok", [
    ("2022-04-27 03:18:39", True), ("2022-04-27T03:18:39", False), ("2022-04-27", False),
    ("2022-13-01 00:00:00", False), ("2022-04-27 25:00:00", False), ("", False), (None, False),
    ("2024-03-10 02:30:00", True),
])
def test_parse_local(spark, text, ok):
    df = spark.createDataFrame([(text,)], "t string").select(times.parse_local("t").cast("string"))
    assert df.first()[0] == (text if ok else None)


@pytest.mark.parametrize("birthday, as_of, age", [
    ("1988-01-10", "2024-01-01", 35 + 1), ("2023-01-02", "2024-01-01", 0), ("2023-01-01", "2024-01-01", 1),
    ("2025-06-01", "2024-01-01", -1), (None, "2024-01-01", 0),
])
def test_age_counts_years_of_365_days(spark, birthday, as_of, age):
    df = spark.createDataFrame([(birthday,)], "b string")
    assert df.select(times.age_in_years("b", F.lit(as_of))).first()[0] == age
