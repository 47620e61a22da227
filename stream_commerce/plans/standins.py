"""Views of the Parquet test tables in the shape of the business records.

These only rename and derive columns; every function covers the whole table and works on a stream
of the same table as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stream_commerce.functions.times import epoch_ms, epoch_us
from stream_commerce.schemas import MONEY, ORDER_INFO_TOPIC
from stream_commerce.sources.tables import table


def events_of(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def _k() -> Column:
    return F.get_json_object("props", "$.k")


def cut_logs(events: DataFrame, cut: Column) -> DataFrame:
    """The raw logs of the events; where `cut` holds, without their last character."""
    logs = raw_logs(events.withColumn("_cut", cut), "_cut")
    whole = F.col("value")
    return logs.select(F.when(F.col("_cut"), whole.substr(F.lit(1), F.length(whole) - 1)).otherwise(whole).alias("value"))


def raw_logs(events: DataFrame, *keep: str) -> DataFrame:
    """JSON logs: sign-ups are starts, errors carry both `err` and `start`, the rest are pages with
    two actions of which the second overrides `os` and has no item. Columns to `keep` come along."""
    common = F.struct(
        F.concat(F.lit("mid_"), F.col("user_id") % 40).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.lit("x").alias("os"),
    ).alias("common")
    start = F.struct(_k().cast("int").alias("loading_time"))
    first = F.struct(
        F.col("event_type").alias("action_id"), _k().alias("item"), F.lit(None).cast("string")
        .alias("os"),
    )
    second = F.struct(
        F.lit("second").alias("action_id"), F.lit(None).cast("string").alias("item"),
        F.lit("y").alias("os"),
    )
    page = F.struct(F.concat(F.lit("p"), F.col("user_id") % 7).alias("page_id"))
    is_start = F.col("event_type").isin("signup", "error")
    return events.select(F.to_json(F.struct(
        common,
        F.when(is_start, start).alias("start"),
        F.when(~is_start, page).alias("page"),
        F.when(~is_start, F.array(first, second)).alias("actions"),
        F.when(F.col("event_type") == "error", F.struct(F.lit(1).alias("code"))).alias("err"),
        epoch_ms("ts").alias("ts"),
    )).alias("value"), *keep)


def start_rows(events: DataFrame, *keep: str) -> DataFrame:
    """Sign-ups as typed start records. Columns to `keep` come along."""
    return events.filter(F.col("event_type") == "signup").select(
        F.concat(F.lit("mid_"), F.col("user_id") % 40).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        _k().alias("loading_time"),
        epoch_ms("ts").alias("ts"),
        *keep,
    )


def action_rows(events: DataFrame) -> DataFrame:
    """All events as typed actions on five shared devices."""
    return events.select(
        F.concat(F.lit("mid_"), F.col("user_id") % 5).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.col("event_type").alias("action_id"),
        _k().alias("item"),
        epoch_ms("ts").alias("ts"),
    )


def spoiled_messages(rows: DataFrame) -> DataFrame:
    """Rows as JSON texts; where `item` or `loading_time` is 90 or more the time is a word, under 10 it is missing."""
    k = F.coalesce(*[F.col(c).cast("int") for c in ("item", "loading_time") if c in rows.columns])
    ts = F.when(k >= 90, "soon").when(k >= 10, F.col("ts").cast("string"))
    return rows.select(F.to_json(F.struct(*[c for c in rows.columns if c != "ts"], ts.alias("ts"))).alias("value"))


def purchases(events: DataFrame) -> DataFrame:
    """Purchases are orders with a time of day."""
    return events.filter(F.col("event_type") == "purchase")


def purchase_orders(events: DataFrame) -> DataFrame:
    """Purchases with text create_time and amount as a database row change carries them."""
    return purchases(events).select(
        F.col("event_id").cast("string").alias("id"),
        F.substring(F.col("ts").cast("string"), 1, 19).alias("create_time"),
        F.col("value").cast(MONEY).cast("string").alias("total_amount"),
        F.col("user_id").cast("string").alias("user_id"),
    )


def order_messages(events: DataFrame) -> DataFrame:
    """The same as JSON messages with every value quoted."""
    columns = ["id", "create_time", "total_amount", "user_id"]
    return purchase_orders(events).select(F.to_json(F.struct(*columns)).alias("value"))


def repeated_order_messages(events: DataFrame, after: str) -> DataFrame:
    """Order messages (topic, id, value, arrived); every third is sent again, with its id, `after` the first."""
    columns = ["id", "create_time", "total_amount", "user_id"]
    orders = purchase_orders(events).select(
        F.lit(ORDER_INFO_TOPIC).alias("topic"), "id", F.to_json(F.struct(*columns)).alias("value"),
        F.to_timestamp("create_time").alias("arrived"))
    again = orders.filter(F.col("id").cast("bigint") % 3 == 0)
    return orders.unionByName(again.withColumn("arrived", F.col("arrived") + F.expr(f"INTERVAL {after}")))


def spoiled_order_messages(events: DataFrame) -> DataFrame:
    """Order messages whose create_time or amount is unreadable for some values of k."""
    k = _k().cast("int")
    columns = purchases(events).select(
        F.col("event_id").cast("string").alias("id"),
        F.when(k >= 90, F.lit("yesterday"))
        .otherwise(F.substring(F.col("ts").cast("string"), 1, 19)).alias("create_time"),
        F.when(k < 10, F.lit("n/a"))
        .otherwise(F.col("value").cast(MONEY).cast("string")).alias("total_amount"),
    )
    return columns.select(F.to_json(F.struct("*")).alias("value"))


def order_headers(orders: DataFrame) -> DataFrame:
    """`orders` as order headers; 27 province ids of which 25 exist."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit(""), F.col("o_custkey") % 27).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_totalprice").cast(MONEY).cast("string").alias("total_amount"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 19).alias("create_time"),
    )


def order_lines(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """`lineitem` with part names as order lines."""
    names = part.select("p_partkey", F.col("p_name").alias("sku_name"))
    return lineitem.join(names, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        "sku_name",
        F.col("l_extendedprice").cast(MONEY).cast("string").alias("order_price"),
        F.col("l_quantity").cast("int").cast("string").alias("sku_num"),
    )


def users(customer: DataFrame) -> DataFrame:
    """`customer` as users. Customers in debt have no user row."""
    birthday = F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int"))
    return customer.filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("login_name"),
        F.col("c_mktsegment").alias("user_level"),
        birthday.cast("string").alias("birthday"),
        F.when(F.col("c_nationkey") < 12, "F").otherwise("M").alias("gender"),
    )


def provinces(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("region_id"),
        F.lit("0").alias("area_code"),
        F.concat(F.lit("ISO-"), "n_nationkey").alias("iso_code"),
        F.concat(F.lit("CN-"), "n_nationkey").alias("iso_3166_2"),
    )


def row_changes(orders: DataFrame) -> DataFrame:
    """`orders` as row changes of three tables, two rows per statement."""

    def image(customer: Column) -> Column:
        return F.array(
            F.struct(F.lit("id").alias("name"), customer.cast("string").alias("value")),
            F.struct(F.lit("user_level").alias("name"), F.col("o_orderstatus").alias("value")),
        )

    key = F.col("o_orderkey")
    return orders.select(
        F.when(key % 4 == 0, "user_info").when(key % 4 == 1, "order_detail")
        .otherwise("order_info").alias("table"),
        F.when(F.col("o_orderpriority") == "5-LOW", "TRANSACTIONEND").otherwise("ROWDATA")
        .alias("kind"),
        F.when(key % 5 == 0, "DELETE").when(key % 5 <= 2, "UPDATE").otherwise("INSERT")
        .alias("op"),
        key.alias("seq"),
        epoch_ms("o_orderdate").alias("ts"),
        F.array(image(F.col("o_custkey")), image(F.col("o_custkey") + 1)).alias("rows"),
    )


def timed(events: DataFrame, event_type: str, id_name: str, time_name: str) -> DataFrame:
    """(user_id, id, time in microseconds) of one event type."""
    return events.filter(F.col("event_type") == event_type).select(
        "user_id", F.col("event_id").alias(id_name), epoch_us("ts").alias(time_name)
    )
