"""A third of all rows on one key: Spark must be able to split it, and results stay whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stream_commerce.operators import alerts, intervals, pairing

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.shuffle.partitions": "16",
}
ROWS = 300_000


@pytest.fixture
def session(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def hot_lines(spark):
    """Every third row belongs to order 0, the rest is spread over 100,000 orders."""
    n = F.col("id")
    return spark.range(0, ROWS, 1, 16).select(
        F.when(n % 3 == 0, F.lit(0)).otherwise(n % 100_000).alias("order_id"), n.alias("line"),
        (n % 1000).alias("detail_at"),
    )


def run(df):
    """Row count and final plan."""
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    n = counted.collect()[0].n
    return n, counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_pairing_splits_a_hot_order(session):
    orders = session.range(100_000).select(
        F.col("id").alias("order_id"), F.lit("2024-01-01").cast("timestamp").alias("order_ts")
    )
    lines = hot_lines(session).select(
        "order_id", "line", F.lit("2024-01-01").cast("timestamp").alias("detail_ts")
    )
    n, plan = run(pairing.pair_orders(orders, lines))
    assert n == ROWS and "skew=true" in plan


def test_pairing_states_split_a_hot_order(session):
    orders = session.range(100_000).select(F.col("id").alias("order_id"), F.lit(500).alias("order_at"))
    states = pairing.pairing_states(orders, hot_lines(session), 1000)
    counts = {r.state: r.cnt for r in states.collect()}
    plan = states._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert counts["matched"] == ROWS and "early_detail" not in counts
    assert "skew=true" in plan


def test_unpaired_rows_split_a_hot_cell(session):
    rows = hot_lines(session).withColumn("at", F.lit(5))
    others = session.range(1, 50_000).select(F.col("id").alias("order_id"), F.lit(7).alias("other_at"))
    n, plan = run(intervals.without_partner(rows, others, ["order_id"], "at", "other_at", 10))
    expected = rows.filter("order_id = 0 or order_id >= 50000").count()
    assert n == expected and "skew=true" in plan


def test_interval_pairs_split_a_hot_cell(session):
    left = session.range(100_000).select(F.col("id").alias("order_id"), F.lit(7).alias("other_at"))
    right = hot_lines(session).withColumn("at", F.lit(5))
    n, plan = run(intervals.interval_pairs(left, right, ["order_id"], "other_at", "at", 10))
    assert n == ROWS and "skew=true" in plan


def test_alert_events_split_a_hot_user(session):
    n = F.col("id")
    actions = session.range(0, ROWS, 1, 16).select(
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), n % 50_000)).alias("mid"),
        F.when(n % 3 == 0, F.when(n == 3, "v").otherwise("u"))
        .otherwise(F.concat(F.lit("u"), n)).alias("uid"),
        F.when(n < 9, "trade_add_address").otherwise("cart_add").alias("action_id"),
        F.lit(None).cast("string").alias("item"), F.lit(1_704_067_200_000).alias("ts"),
    )
    windows = alerts.alert_windows(actions)
    n_events, plan = run(alerts.alert_events(actions, windows))
    assert n_events == 10 * ROWS // 3 and "skew=true" in plan
    rows = alerts.alert_rows(actions, windows).groupBy("kind").count().collect()
    # Device hot: two suspects in each of ten windows, and no item.
    assert {r["kind"]: r["count"] for r in rows} == {"event": n_events, "user": 20}
