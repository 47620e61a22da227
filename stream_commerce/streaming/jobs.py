"""The streaming jobs. Each takes streams and tables and returns the started query.

Jobs that keep a table write it through a `BatchTable`, so a batch that is replayed after a failure
does not change it. Topic writers are at least once: Kafka may get the rows of a replayed batch
twice, so readers that add up must drop repeats: by order id (`run_gmv(once_within=...)`), or by the
message ids of `run_change_topics(ids=True)` (`topics.once`). The checkpoint keeps the positions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from stream_commerce.functions.records import CORRUPT, parse_json
from stream_commerce.functions.times import SHANGHAI
from stream_commerce.operators import alerts, changes, diversion, first_start, gmv, pairing, sales
from stream_commerce.operators.joins import null_safe_join
from stream_commerce.operators.latest import first_per_key
from stream_commerce.operators.words import side_by_side, word_counts
from stream_commerce.schemas import (
    ACTION_TOPIC,
    ORDER_DETAIL,
    SALE_DETAIL_COLUMNS,
    START_LOG_COLUMNS,
    START_TOPIC,
    USER_INFO,
)
from stream_commerce.streaming.batch_table import (
    BATCH_ID,
    FOLDER_FILES,
    BatchTable,
    DatedTable,
    KeyedTable,
    add_up,
    keep_last,
)
from stream_commerce.streaming.sinks import CountListener, counted

TEN_SECONDS = {"processingTime": "10 seconds"}
UNTIL_DRAINED = {"availableNow": True}
Reader = Callable[[SparkSession], DataFrame]
# Takes the rows of a batch that a job cannot use, and the batch's id.
Aside = Callable[[DataFrame, int], None]


def start(
    writer: DataStreamWriter, name: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    return (
        writer.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TEN_SECONDS))
        .start()
    )


def _each_batch(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], name: str, checkpoint: str,
    trigger: dict | None, mode: str = "append",
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(handle)
    return start(writer, name, checkpoint, trigger)


# Log diversion -----------------------------------------------------------------------------


def run_diversion(
    raw: DataFrame, writer_of: Callable[[DataFrame], DataStreamWriter], checkpoint: str,
    trigger: dict | None = None, name: str = "log_diversion",
) -> StreamingQuery:
    """Raw logs to start and action topics: one stateless query, no shuffle.

    Observed per batch (`sinks.BatchCounts`): `logs` read, `starts` and `actions` written.
    """
    rows = diversion.divert(raw.select("value").observe("read", F.count(F.lit(1)).alias("logs")))
    rows = rows.observe(
        "written", F.count_if(F.col("topic") == START_TOPIC).alias("starts"), F.count_if(F.col("topic") == ACTION_TOPIC).alias("actions"))
    return start(writer_of(rows), name, checkpoint, trigger)


def run_unreadable_logs(
    raw: DataFrame, table: BatchTable, checkpoint: str, trigger: dict | None = None, name: str = "unreadable_logs",
) -> StreamingQuery:
    """Keep the raw logs that are no log at all, which the diversion cannot route.

    Observed per batch: `logs` read, `unreadable` ones kept.
    """
    rows = diversion.unreadable_logs(raw.select("value").observe("read", F.count(F.lit(1)).alias("logs")))
    rows = rows.observe("kept", F.count(F.lit(1)).alias("unreadable"))
    return _each_batch(rows, table.write, name, checkpoint, trigger)


# Daily active devices ----------------------------------------------------------------------


def start_table(path: str, run: str = "main") -> DatedTable:
    types = [f"{c} {'bigint' if c == 'ts' else 'string'}" for c in START_LOG_COLUMNS]
    return DatedTable(path, ", ".join(types), "start_date", run)


def run_first_starts(
    starts: DataFrame, table: DatedTable, checkpoint: str, trigger: dict | None = None,
    on_count: CountListener | None = None, on_unreadable: Aside | None = None,
) -> StreamingQuery:
    """Keep each device's first start of the day.

    `on_unreadable` gets the messages without a readable `ts`. `on_count` gets the number of devices a
    batch adds, 0 where all were seen before.

    The table is its own history: a batch drops the devices earlier batches hold for the same date
    and writes the rest. Only the two key columns of the dates present in the batch are read.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = first_start.first_starts(first_start.parse_starts(batch.select("value")))
        found = found.persist()
        try:
            if on_unreadable is not None:
                on_unreadable(first_start.unreadable_texts(batch.select("value")), batch_id)
            # Only the files of this batch's dates are read, in one scan. A batch has few dates; a
            # clock that is wrong adds one, not a span.
            dates = [r[0] for r in found.select("start_date").distinct().collect()]
            history = table.history(spark, dates, before=batch_id).select(*first_start.KEYS)
            table.write(first_start.drop_seen(found, history), batch_id)
            if on_count is not None:
                on_count(batch_id, table.rows(spark, batch_id, dates))
        finally:
            found.unpersist()

    return _each_batch(starts, handle, "first_starts", checkpoint, trigger)


def _days_open(days: int) -> str:
    return f"{days} days 1 second"


def first_start_table(path: str, run: str = "main") -> BatchTable:
    """For `run_first_starts_state`: dates are folders for readers; the job reads none of them."""
    return BatchTable(path, start_table(path).schema, ["start_date"], run, FOLDER_FILES)


def run_first_starts_state(
    starts: DataFrame, table: BatchTable, checkpoint: str, days: int = 1, trigger: dict | None = None,
    on_count: CountListener | None = None,
) -> StreamingQuery:
    """Keep each device's first start of the day, with the devices seen as the query's own state.

    State of a date is dropped once a start comes that is more than `days` days younger, so it holds
    the devices of the open dates and does not grow with history; later starts of that date count no device
    again (`run_outside_starts` keeps them). No history is read.

    A state row is the first start itself, marked with the time of the batch that brought it: batches have a
    time that a replay repeats, and a device is new in a batch if its row has that time. It must not step back.
    """
    now = F.current_timestamp()
    parsed = first_start.with_day(first_start.parse_starts(starts.select("value")))
    timely = parsed.filter(~first_start.ahead(now)).withColumn("seen", now)
    firsts = first_per_key(timely.withWatermark("day", _days_open(days)), ["day", "mid"], ["seen", "ts"])

    def handle(batch: DataFrame, batch_id: int) -> None:
        counted(table, batch, batch_id, on_count)

    return _each_batch(firsts.filter(F.col("seen") == now), handle, "first_starts_state", checkpoint, trigger, "update")


def outside_start_table(path: str, run: str = "main") -> BatchTable:
    return BatchTable(path, "start_date string, mid string, ts bigint, ahead boolean", (), run)


def run_outside_starts(
    starts: DataFrame, table: BatchTable, marks: KeyedTable, checkpoint: str, days: int = 1, trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the starts that `run_first_starts_state` leaves out: of dates that are closed, or after tomorrow (`ahead`)."""
    parsed = first_start.with_day(first_start.parse_starts(starts.select("value")))
    marked = parsed.withColumn("ahead", first_start.ahead(F.current_timestamp()))
    return run_late_rows(marked, "day", table, marks, checkpoint, trigger, _days_open(days), aside=F.col("ahead"))


def first_start_view(spark: SparkSession, table: BatchTable) -> DataFrame:
    """(start_date, mid) is unique here: no batch writes a device an earlier one holds."""
    return table.read(spark).drop(BATCH_ID)


# Hourly sales ------------------------------------------------------------------------------


def gmv_table(path: str, run: str = "main") -> BatchTable:
    return BatchTable(path, "create_date string, create_hour string, gmv decimal(26,2)", (), run)


GMV_FOLD = add_up(gmv.KEYS, "gmv")


def unreadable_order_table(path: str, run: str = "main") -> BatchTable:
    """Orders whose time or amount cannot be read, as far as they can be read."""
    return BatchTable(path, f"id string, create_time string, {CORRUPT} string", (), run)


def unreadable_table(path: str, run: str = "main") -> BatchTable:
    """Messages that a job cannot use, as they came."""
    return BatchTable(path, "value string", (), run)


def run_gmv(
    orders: DataFrame, table: BatchTable, checkpoint: str, trigger: dict | None = None,
    once_within: str | None = None,
    on_unreadable: Aside | None = None,
) -> StreamingQuery:
    """Per-batch sums per date and hour; the total is the sum over batches.

    Two feeders may send the same order. With `once_within`, an order id that arrives again within
    that time is not counted again; the ids of that span are kept as state. Where only the writer's
    replays are to be left out, give it `topics.once(messages, within)` instead.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if on_unreadable is None:
            table.write(gmv.partial_totals(gmv.readable(batch)), batch_id)
            return
        batch = batch.persist()
        try:
            table.write(gmv.partial_totals(gmv.readable(batch)), batch_id)
            on_unreadable(gmv.unreadable(batch), batch_id)
        finally:
            batch.unpersist()

    if once_within is None:
        parsed = gmv.parse_orders(orders.select("value"), fields=["id"])
    else:
        parsed = gmv.parse_orders(orders.select("value", "arrived"), fields=["id"])
        parsed = parsed.withWatermark("arrived", once_within).dropDuplicatesWithinWatermark(["id", CORRUPT])
    return _each_batch(parsed, handle, "gmv", checkpoint, trigger)


def gmv_view(spark: SparkSession, table: BatchTable) -> DataFrame:
    return gmv.fold_totals(table.read(spark))


POSITION = ("topic", "partition")


def ledger_table(path: str, run: str = "main") -> BatchTable:
    """Sums and positions in one table: kind `sum` has (create_date, create_hour, gmv), kind `position` has the
    offset that follows the last one counted of each topic partition. Both are one write of a batch."""
    return BatchTable(path, "kind string, create_date string, create_hour string, gmv decimal(26,2), "
                      "topic string, partition int, next bigint", ["kind"], run)


def run_gmv_ledger(
    orders: DataFrame, table: BatchTable, checkpoint: str, since: DataFrame | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Per-batch sums with the positions (topic, partition, offset) of the messages they hold.

    A job that lost its checkpoint starts over with a new one and a new run of the table, and gives as `since`
    the `ledger_positions` of the earlier runs: what they counted is left out, and nothing else. On Kafka
    `sources.topics` makes starting offsets of them, so what was counted is not even read.
    """
    columns = [*POSITION, "offset", "value"]
    if since is not None:  # one row per topic partition
        done = F.broadcast(since.select(*[F.col(c).alias(f"_{c}") for c in (*POSITION, "next")]))
        same = (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition"))
        orders = orders.join(done, same, "left").filter(F.col("_next").isNull() | (F.col("offset") >= F.col("_next")))

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            sums = gmv.partial_totals(gmv.readable(gmv.parse_orders(batch.select("value"), fields=["id"])))
            ends = batch.groupBy(*POSITION).agg((F.max("offset") + 1).alias("next"))
            rows = sums.withColumn("kind", F.lit("sum")).unionByName(ends.withColumn("kind", F.lit("position")), allowMissingColumns=True)
            table.write(rows, batch_id)
        finally:
            batch.unpersist()

    return _each_batch(orders.select(*columns), handle, "gmv_ledger", checkpoint, trigger)


def ledger_positions(spark: SparkSession, *tables: BatchTable) -> DataFrame:
    """(topic, partition, next) over all runs given."""
    rows = [t.read(spark).filter("kind = 'position'").select(*POSITION, "next") for t in tables]
    return reduce(DataFrame.unionByName, rows).groupBy(*POSITION).agg(F.max("next").alias("next"))


def ledger_view(spark: SparkSession, *tables: BatchTable) -> DataFrame:
    """Totals over all runs given."""
    rows = [t.read(spark).filter("kind = 'sum'").select(*gmv.KEYS, "gmv") for t in tables]
    return gmv.fold_totals(reduce(DataFrame.unionByName, rows))


def run_gmv_state(orders: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Total amount per date and hour kept as the query's own state, over all batches and restarts.

    Nothing is written but the checkpoint; `gmv_state_view` reads the totals from it.
    """
    parsed = gmv.parse_orders(orders.select("value"), fields=["id"])
    return _each_batch(gmv.partial_totals(gmv.readable(parsed)), lambda batch, batch_id: batch.write.format("noop").mode("overwrite").save(),
                       "gmv_state", checkpoint, trigger, "update")


def gmv_state_view(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(create_date, create_hour, gmv) as of the last finished batch."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(*[F.col(f"key.{k}") for k in gmv.KEYS], F.col("value.sum").alias("gmv"))


# Actions by event time ---------------------------------------------------------------------


def action_table(path: str, run: str = "main") -> BatchTable:
    return BatchTable(
        path, "mid string, uid string, action_id string, item string, ts bigint, date string", ["date"], run)


def run_action_log(
    actions: DataFrame, table: BatchTable, checkpoint: str, trigger: dict | None = None, on_unreadable: Aside | None = None,
) -> StreamingQuery:
    """Keep the parsed actions by the date of their own time, however late they arrive."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        date = F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd")
        rows = alerts.parse_actions(batch.select("value")).withColumn("date", date)
        table.write(rows, batch_id)
        if on_unreadable is not None:
            on_unreadable(alerts.unreadable_actions(batch.select("value")), batch_id)

    return _each_batch(actions, handle, "action_log", checkpoint, trigger)


def actions_between(spark: SparkSession, table: BatchTable, from_ms: int, to_ms: int) -> DataFrame:
    """Kept actions with from_ms <= ts < to_ms; only the dates in between are read."""
    at = [F.date_format(F.timestamp_millis(F.lit(x)), "yyyy-MM-dd") for x in (from_ms, to_ms)]
    return table.read(spark).filter(
        F.col("date").between(*at) & (F.col("ts") >= from_ms) & (F.col("ts") < to_ms)
    ).select("mid", "uid", "action_id", "item", "ts")


# Alerts ------------------------------------------------------------------------------------


ALERT_SCHEMA = (
    "id string, mid string, window_end bigint, users bigint, kind string, uid string, item string, "
    "action_id string, ts bigint, date string"
)


def alert_table(path: str, run: str = "main") -> BatchTable:
    return BatchTable(path, ALERT_SCHEMA, ["date"], run, FOLDER_FILES)


def stream_alert_windows(
    actions: DataFrame, rule: alerts.AlertRule = alerts.DEFAULT_RULE,
    lateness: str = "5 minutes",
) -> DataFrame:
    """`alerts.alert_windows` over a stream: (mid, window_end, users) once a window is closed.

    Three aggregates in a chain. The first keeps one row per pane (the step of the windows), device and
    suspect while late actions may still come; only a closed pane is copied into the windows that hold it, so
    the state of open panes does not grow with the number of windows an action is in. No action is kept.
    """
    event_time = F.timestamp_millis("ts").alias("at")
    triggers = (
        actions.filter(F.col("action_id") == rule.trigger)
        .select("mid", "uid", event_time)
        .withWatermark("at", lateness)
    )
    # Windows begin at multiples of their step and end a window's length later: panes of the common
    # divisor lie in a window wholly or not at all.
    pane = F.window("at", f"{math.gcd(rule.window_ms, rule.slide_ms)} milliseconds").alias("pane")
    panes = triggers.groupBy(pane, "mid", "uid").agg(F.count(F.lit(1)).alias("times"))
    window = F.window(
        F.window_time("pane"), f"{rule.window_ms} milliseconds", f"{rule.slide_ms} milliseconds"
    ).alias("window")
    users = panes.groupBy(window, "mid", "uid").agg(F.sum("times").alias("times"))
    counted_users = users.groupBy("window", "mid").agg(F.count(F.lit(1)).alias("users"))
    return counted_users.filter(F.col("users") >= rule.min_users).select(
        "mid", F.unix_millis("window.end").alias("window_end"), "users"
    )


def suspect_table(path: str, run: str = "main") -> BatchTable:
    return BatchTable(path, "mid string, uid string, window_end bigint, date string", ["date"], run, FOLDER_FILES)


def run_early_alerts(
    actions: DataFrame, table: BatchTable, checkpoint: str, rule: alerts.AlertRule = alerts.DEFAULT_RULE,
    trigger: dict | None = None, lateness: str = "5 minutes",
) -> StreamingQuery:
    """Keep the suspects of every window as soon as they are seen, while the window is open.

    One aggregate in update mode: a batch gets the (window, device, user) rows that changed. They are a set, so
    rows that come again change nothing; `early_alert_view` counts them. State has a small row per window,
    device and user until the watermark passes the window.
    """
    at = F.timestamp_millis("ts").alias("at")
    triggers = alerts.parse_actions(actions.select("value")).filter(F.col("action_id") == rule.trigger).select(
        "mid", "uid", at).withWatermark("at", lateness)
    window = F.window("at", f"{rule.window_ms} milliseconds", f"{rule.slide_ms} milliseconds").alias("window")
    seen = triggers.groupBy(window, "mid", "uid").agg(F.count(F.lit(1)).alias("times"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        end = F.unix_millis("window.end").alias("window_end")
        date = F.date_format(F.col("window.end"), "yyyy-MM-dd").alias("date")
        table.write(batch.select("mid", "uid", end, date), batch_id)

    return _each_batch(seen, handle, "early_alerts", checkpoint, trigger, "update")


def early_alert_view(
    spark: SparkSession, table: BatchTable, rule: alerts.AlertRule = alerts.DEFAULT_RULE, before: int | None = None,
) -> DataFrame:
    """(mid, window_end, users) as known so far; a window's later count replaces its earlier one."""
    users = table.read(spark, before).select("mid", "uid", "window_end").distinct()
    return alerts.alert_windows(users, rule, users)


def run_alerts(
    actions: DataFrame,
    action_log: Callable[[SparkSession, int, int], DataFrame],
    table: BatchTable,
    checkpoint: str,
    rule: alerts.AlertRule = alerts.DEFAULT_RULE,
    trigger: dict | None = None,
    lateness: str = "5 minutes",
    on_count: CountListener | None = None,
) -> StreamingQuery:
    """Decide alerts in the stream, then read their actions back from the log.

    `action_log(spark, from_ms, to_ms)` returns the parsed actions of a time range: a topic range
    or the folder the diversion job writes. The log still has them because a window closes only
    `lateness` after its end.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        windows = alerts.latest_per_minute(batch).persist()
        try:
            span = windows.agg(F.min("window_end"), F.max("window_end")).first()
            if span[0] is None:
                rows = spark.createDataFrame([], ALERT_SCHEMA)
            else:
                first_ms, end_ms = span[0] - rule.window_ms, span[1]
                log = action_log(spark, first_ms, end_ms).filter(
                    (F.col("ts") >= first_ms) & (F.col("ts") < end_ms)
                )
                rows = alerts.alert_rows(log, windows.drop("id"), rule)
            counted(table, rows, batch_id, on_count)
        finally:
            windows.unpersist()

    stream = stream_alert_windows(alerts.parse_actions(actions.select("value")), rule, lateness)
    return _each_batch(stream, handle, "coupon_alerts", checkpoint, trigger)


def alert_view(spark: SparkSession, table: BatchTable) -> DataFrame:
    """Last alert per id: a later window of the same minute replaces the earlier one."""
    rows = table.read(spark)
    key = ["date", "mid", "id"]
    newest = rows.groupBy(*key).agg(F.max("window_end").alias("window_end"))
    return null_safe_join(rows, newest, [*key, "window_end"], "left_semi").drop(BATCH_ID)


# Sales -------------------------------------------------------------------------------------


def sale_table(path: str, run: str = "main", by: Sequence[str] = ("status", "dt")) -> BatchTable:
    """`by` names the folders; leave out `dt` where one batch spans very many days."""
    numbers = {"user_age": "int", "sku_price": "double", "sku_num": "int"}
    types = [f"{c} {numbers.get(c, 'string')}" for c in (*SALE_DETAIL_COLUMNS, "status")]
    return BatchTable(path, ", ".join(types), by, run)


SALE_FOLD = keep_last(["order_detail_id"])


def stream_pairs(
    orders: DataFrame, details: DataFrame, allowance: str = pairing.ALLOWANCE,
    salts: int | None = None,
) -> DataFrame:
    """Header and line messages (value, arrived) paired within `allowance`.

    A header that was sent twice is used once. An amount that cannot be read loses no sale: no sale
    column uses it; without a readable create_time the sale has no date (dt null).
    """
    headers, lines = order_streams(orders, details)
    return pairing.pair_orders(headers, lines, allowance, salts, headers_once=True)


def order_streams(orders: DataFrame, details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Header messages with order_id and order_ts, line messages with order_id and detail_ts."""
    headers = sales.order_part(
        gmv.parse_orders(orders.select("value", "arrived")), "arrived"
    ).withColumnRenamed("arrived", "order_ts")
    lines = sales.detail_part(parse_details(details), "arrived").withColumnRenamed(
        "arrived", "detail_ts"
    )
    return headers, lines


INFO_ONLY, EARLY_DETAIL = "info_only", "early_detail"


def unpaired_table(path: str, run: str = "main") -> BatchTable:
    """Headers and lines that found no partner; `row` is the whole row as JSON."""
    return BatchTable(path, "kind string, order_id string, arrived timestamp, row string", ["kind"], run)


def run_unpaired(
    headers: DataFrame, lines: DataFrame, table: BatchTable, checkpoint: str, trigger: dict | None = None,
    allowance: str = pairing.ALLOWANCE, headers_once: bool = True,
) -> StreamingQuery:
    """Keep the headers and lines (of `order_streams`) that have no partner within `allowance`.

    A full outer join of the streams: what the watermark evicts unpaired is kept as it came. Rows that come
    after the watermark are in neither result; see `run_late_rows`.
    """
    def tagged(rows: DataFrame, name: str, time: str) -> DataFrame:
        return rows.select("order_id", time, F.to_json(F.struct("*")).alias(name))

    both = pairing.pair_orders(
        tagged(headers, "header", "order_ts"), tagged(lines, "line", "detail_ts"), allowance, how="fullOuter", headers_once=headers_once)
    lost = F.col("header").isNull() | F.col("line").isNull()

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.write(batch.filter(lost).select(
            F.when(F.col("line").isNull(), INFO_ONLY).otherwise(EARLY_DETAIL).alias("kind"), "order_id",
            F.coalesce("order_ts", "detail_ts").alias("arrived"), F.coalesce("header", "line").alias("row")), batch_id)

    return _each_batch(both, handle, "unpaired", checkpoint, trigger)


def mark_table(path: str, run: str = "main") -> KeyedTable:
    """The latest event time that a job has seen: one row."""
    return KeyedTable(path, "name string, high timestamp", ["name"], ["high"], buckets=1, run=run)


def run_late_rows(
    rows: DataFrame, time: str, table: BatchTable, marks: KeyedTable, checkpoint: str,
    trigger: dict | None = None, allowance: str = pairing.ALLOWANCE, aside: Column | None = None,
) -> StreamingQuery:
    """Keep the rows that a job with a watermark of `allowance` on `time` finds too late. Rows that hold `aside`
    are kept as well, and their time is not looked at.

    As Spark does, a batch is held against the latest time of the batches before it, less the allowance. That
    time is a row of `marks`, read as it was before the batch, so a replay splits the batch the same way. Rows
    without a time are never late.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = marks.read(spark, before=batch_id).first()
        bound = F.lit(seen["high"] if seen else None).cast("timestamp") - F.expr(f"INTERVAL {allowance}")
        batch = batch.persist()
        try:
            odd = F.lit(False) if aside is None else aside
            table.write(batch.filter((F.col(time) < bound) | odd), batch_id)
            high = batch.filter(~odd).agg(F.max(time).alias("high")).filter("high is not null")
            marks.write(high.select(F.lit("high").alias("name"), "high"), batch_id)
        finally:
            batch.unpersist()

    return _each_batch(rows, handle, "late_rows", checkpoint, trigger)


def parse_details(details: DataFrame) -> DataFrame:
    return parse_json(details.select("value", "arrived"), ORDER_DETAIL)


def run_sales(
    orders: DataFrame,
    details: DataFrame,
    users: Reader,
    provinces: Reader,
    table: BatchTable,
    checkpoint: str,
    as_of: Column | None = None,
    trigger: dict | None = None,
    allowance: str = pairing.ALLOWANCE,
    salts: int | None = None,
    on_count: CountListener | None = None,
) -> StreamingQuery:
    """Pair headers and lines, add buyer and province, keep one row per order line.

    Users and provinces are read per batch, so the join sees their current rows. Rows of an unknown
    province are kept under status `unknown_province`.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # One day for the whole batch, in the zone of the business dates.
        today = as_of if as_of is not None else F.to_date(F.from_utc_timestamp(F.to_utc_timestamp(
            F.current_timestamp(), F.current_timezone()), SHANGHAI))
        rows = sales.with_users(sales.with_provinces(batch, provinces(spark)), users(spark), today)
        rows = sales.sale_columns(rows)
        counted(table, rows, batch_id, on_count)

    stream = stream_pairs(orders, details, allowance, salts)
    return _each_batch(stream, handle, "sale_details", checkpoint, trigger)


def sale_view(spark: SparkSession, table: BatchTable, status: str = sales.OK) -> DataFrame:
    """Last row per order line."""
    rows = table.read(spark).filter(F.col("status") == status)
    return SALE_FOLD(rows).drop(BATCH_ID)


# Row changes -------------------------------------------------------------------------------


def user_table(path: str, run: str = "main", buckets: int = 16) -> KeyedTable:
    """The last row of each user by its position in the change log."""
    fields = [f"{c} string" for c in USER_INFO.fieldNames()]
    return KeyedTable(path, ", ".join([*fields, "seq bigint", "pos int", "ts bigint"]), ["id"], ["seq", "pos"], buckets, run)


def run_change_topics(
    stream: DataFrame, writer_of: Callable[[DataFrame], DataStreamWriter], checkpoint: str,
    trigger: dict | None = None, ids: bool = False,
) -> StreamingQuery:
    """Inserted orders and order lines to their topics; with `ids`, messages also say their place in the change
    log, so that readers can drop what a replayed batch sends again (`topics.once`)."""
    rows = changes.messages(stream) if ids else changes.topic_rows(stream)
    return start(writer_of(rows), "change_topics", checkpoint, trigger)


def run_user_state(
    stream: DataFrame, table: KeyedTable, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Inserted and updated users to the user table, which holds one row per user.

    The columns come from the after-images; no JSON is made or parsed.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.write(changes.latest_users(changes.user_columns(batch, USER_INFO.fieldNames())), batch_id)

    return _each_batch(stream, handle, "user_state", checkpoint, trigger)


def user_view(spark: SparkSession, table: KeyedTable, now_ms: Column | int) -> DataFrame:
    """Current users (id, login_name, user_level, birthday, gender) written within a week."""
    return changes.unexpired(table.read(spark), now_ms).select(*USER_INFO.fieldNames())


# Word counts -------------------------------------------------------------------------------


def word_table(path: str, run: str = "main") -> BatchTable:
    return BatchTable(path, "word string, cnt bigint", (), run)


WORD_FOLD = add_up(["word"], "cnt")


def run_word_counts(
    lines: DataFrame, table: BatchTable, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Per-batch word counts; the running count is the sum over batches."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.write(word_counts(batch), batch_id)

    return _each_batch(lines, handle, "word_counts", checkpoint, trigger)


def word_view(spark: SparkSession, table: BatchTable) -> DataFrame:
    return WORD_FOLD(table.read(spark)).drop(BATCH_ID)


def word_join_table(path: str, run: str = "main") -> BatchTable:
    return BatchTable(path, "word string, left_cnt bigint, right_cnt bigint", (), run)


def run_word_joins(
    left: DataFrame, right: DataFrame, how: str, table: BatchTable, checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Join of the two word counts of each batch (not of the running counts)."""
    tagged = left.select(F.lit("left").alias("side"), "value").unionByName(
        right.select(F.lit("right").alias("side"), "value")
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.write(side_by_side(batch, how), batch_id)

    return _each_batch(tagged, handle, "word_joins", checkpoint, trigger)
