"""Every registered query, next to the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stream_commerce.config import new_work_dir
from stream_commerce.functions import times
from stream_commerce.functions.records import parse_json
from stream_commerce.operators import alerts, changes, diversion, first_start, gmv, intervals
from stream_commerce.operators import pairing, sales, words
from stream_commerce.operators.latest import last_per_key
from stream_commerce.plans import standins
from stream_commerce.schemas import ACTION_LOG, MONEY, SALE_DETAIL_COLUMNS
from stream_commerce.sources.tables import table
from stream_commerce.sources.topics import once, saved_offsets
from stream_commerce.streaming import jobs, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# SQL pieces shared by several checks.
_MS = "(epoch_us(ts) // 1000)"
_LOCAL = "(ts + interval 8 hour)"
_K = "json_extract_string(props, '$.k')"
_STARTS = f"""
  select 'mid_' || (user_id % 40) mid, user_id::varchar uid, {_MS} ms, {_LOCAL} lt, {_K} k
  from events where event_type = 'signup'"""
_FIRST_STARTS = f"""
  with s as ({_STARTS}), f as (
    select *, row_number() over (
      partition by strftime(lt, '%Y-%m-%d'), mid order by ms, uid, k) rn
    from s)
  select strftime(lt, '%Y-%m-%dT%H:%M:%S') || '_' || mid id, mid, uid, ms ts,
         strftime(lt, '%Y-%m-%d') start_date, strftime(lt, '%Y-%m-%dT%H:%M:%S') start_time
  from f where rn = 1"""
_GMV_HOURS = """
  select strftime(ts, '%Y-%m-%d') create_date, strftime(ts, '%H') create_hour,
         sum(value::decimal(16,2))::double gmv
  from events where event_type = 'purchase' group by 1, 2"""


def _gmv_output(totals: DataFrame) -> DataFrame:
    return totals.select("create_date", "create_hour", F.col("gmv").cast("double").alias("gmv"))


# Logs --------------------------------------------------------------------------------------


@query("""
  select case event_type when 'signup' then 'start' when 'error' then 'dropped' else 'action' end
           route, count(*) logs
  from events group by 1""")
def log_route_counts(spark: SparkSession, folder: str) -> DataFrame:
    return diversion.route_counts(standins.raw_logs(standins.events_of(spark, folder)))


@query(f"""
  select 'mid_' || (user_id % 40) mid, user_id::varchar uid, 'x' os, {_K} loading_time, {_MS} ts
  from events where event_type = 'signup'""")
def log_starts(spark: SparkSession, folder: str) -> DataFrame:
    raw = standins.raw_logs(standins.events_of(spark, folder))
    starts = first_start.parse_starts(diversion.divert(raw, only=diversion.START))
    return starts.select("mid", "uid", "os", "loading_time", "ts")


@query(f"""
  with e as (select *, unnest([1, 2]) n from events where event_type not in ('signup', 'error'))
  select 'mid_' || (user_id % 40) mid, user_id::varchar uid, 'p' || (user_id % 7) page_id,
         case n when 1 then event_type else 'second' end action_id,
         case n when 1 then {_K} end item, case n when 1 then 'x' else 'y' end os
  from e""")
def log_actions(spark: SparkSession, folder: str) -> DataFrame:
    raw = standins.raw_logs(standins.events_of(spark, folder))
    actions = parse_json(diversion.divert(raw, only=diversion.ACTION), ACTION_LOG)
    return actions.select("mid", "uid", "page_id", "action_id", "item", "os")


_TOPIC_ROWS = f"""
  with e as (
    select *, unnest(case when event_type = 'signup' then [0] else [1, 2] end) n,
           '{{"mid":"mid_' || (user_id % 40) || '","uid":"' || user_id || '","os":"' common
    from events where event_type <> 'error')
  select case n when 0 then 'REALTIME_STARTUP_LOG' else 'REALTIME_ACTION_LOG' end topic,
         case n
           when 0 then common || 'x","ts":' || {_MS} || ',"loading_time":' || {_K} || '}}'
           when 1 then common || 'x","page_id":"p' || (user_id % 7) || '","action_id":"'
             || event_type || '","item":"' || {_K} || '"}}'
           else common || 'y","page_id":"p' || (user_id % 7)
             || '","action_id":"second"}}' end "value"
  from e"""


@query(_TOPIC_ROWS)
def log_topic_rows(spark: SparkSession, folder: str) -> DataFrame:
    return diversion.divert(standins.raw_logs(standins.events_of(spark, folder)))


@query(_TOPIC_ROWS)
def stream_log_diversion(spark: SparkSession, folder: str) -> DataFrame:
    out, checkpoint = new_work_dir(spark, "topics"), new_work_dir(spark, "checkpoint")
    raw = standins.raw_logs(_stream(spark, folder, "events"))
    jobs.run_diversion(
        raw, lambda rows: sinks.folder_writer(rows, out), checkpoint, jobs.UNTIL_DRAINED
    ).awaitTermination()
    return spark.read.schema("value string, topic string").text(out)


SLICES, SLICE_ROWS = 3, 100_000


def _slice_of(name: str, key: str) -> str:
    """SQL of the batch that `_sliced` puts a row of a table into."""
    return f"""(
      select *, floor(({key} - low) / ceil((high - low + 1) / n))::bigint batch
      from {name}, (select min({key}) low, max({key}) high, greatest({SLICES}, ceil(count(*) / {SLICE_ROWS})) n from {name}))"""


@query(f"""
  select batch, count(*) logs, count(*) filter (event_type = 'signup') starts,
    2 * count(*) filter (event_type not in ('signup', 'error')) actions
  from {_slice_of("events", "event_id")} group by 1""")
def stream_log_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Logs read and records written by each batch of the diversion, observed while it runs."""
    def diverted(events: DataFrame, name: str) -> StreamingQuery:
        out = new_work_dir(spark, "topics")
        return jobs.run_diversion(standins.raw_logs(events), lambda rows: sinks.folder_writer(rows, out),
                                  new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED, name)

    return _observed(spark, _lanes(spark, folder, "events"), diverted, "logs", "starts", "actions")


@query(f"""
  select batch, count(*) logs, count(*) filter (event_id % 10 = 3) unreadable
  from {_slice_of("events", "event_id")} group by 1""")
def stream_unreadable_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Logs read and unreadable ones kept by each batch; every tenth log is cut short."""
    def kept(events: DataFrame, name: str) -> StreamingQuery:
        raw = standins.cut_logs(events, F.col("event_id") % 10 == 3)
        aside = jobs.unreadable_table(new_work_dir(spark, "unreadable"))
        return jobs.run_unreadable_logs(raw, aside, new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED, name)

    return _observed(spark, _lanes(spark, folder, "events"), kept, "logs", "unreadable")


def _observed(
    spark: SparkSession, lanes: list[tuple[int, DataFrame]], run: Callable[[DataFrame, str], StreamingQuery], *names: str,
) -> DataFrame:
    """(batch, names): the observed counts of the queries that `run` starts on each lane, which run side by side; one
    row per batch, numbered from the first slice of its lane."""
    counts = sinks.BatchCounts()
    spark.streams.addListener(counts)
    started: list[tuple[int, StreamingQuery]] = []
    try:
        for i, (first, rows) in enumerate(lanes):
            started.append((first, run(rows, f"lane_{i}")))
        for _, query_ in started:
            query_.awaitTermination()
        found = [(first + batch, *n) for first, query_ in started for batch, *n in counts.of(query_, *names)]
    finally:
        for _, query_ in started:
            query_.stop()
        spark.streams.removeListener(counts)
    return spark.createDataFrame(found, ", ".join(f"{n} bigint" for n in ("batch", *names)))


# Daily active devices ----------------------------------------------------------------------


def _typed_starts(events: DataFrame) -> DataFrame:
    return first_start.with_start_fields(standins.start_rows(events))


@query(_FIRST_STARTS)
def dau_first_start(spark: SparkSession, folder: str) -> DataFrame:
    found = first_start.first_starts(_typed_starts(standins.events_of(spark, folder)))
    return found.select("id", "mid", "uid", "ts", "start_date", "start_time")


@query(_FIRST_STARTS)
def dau_from_raw_logs(spark: SparkSession, folder: str) -> DataFrame:
    raw = standins.raw_logs(standins.events_of(spark, folder))
    starts = first_start.parse_starts(diversion.divert(raw, only=diversion.START))
    found = first_start.first_starts(starts)
    return found.select("id", "mid", "uid", "ts", "start_date", "start_time")


@query(f"""
  with s as (select mid, strftime(lt, '%Y-%m-%d') start_date, ms from ({_STARTS})),
       cut as (select epoch_us(timestamp '2024-01-15 06:00:00') // 1000 cut_ms)
  select distinct start_date, mid from s, cut where ms >= cut_ms and not exists (
    select 1 from s h, cut c where h.ms < c.cut_ms and h.start_date = s.start_date and h.mid = s.mid)
  """)
def dau_history_anti(spark: SparkSession, folder: str) -> DataFrame:
    """A batch that begins at a point in time against all earlier starts as history."""
    starts = _typed_starts(standins.events_of(spark, folder))
    cut = times.epoch_ms(F.lit("2024-01-15 06:00:00").cast("timestamp_ntz"))
    batch = first_start.first_starts(starts.filter(F.col("ts") >= cut))
    history = starts.filter(F.col("ts") < cut).select(*first_start.KEYS).distinct()
    return first_start.drop_seen(batch, history).select(*first_start.KEYS)


@query(f"""
  select strftime(lt, '%Y-%m-%d') start_date, count(distinct mid) devices
  from ({_STARTS}) group by 1""")
def dau_daily_count(spark: SparkSession, folder: str) -> DataFrame:
    return first_start.daily_devices(_typed_starts(standins.events_of(spark, folder)))


@query(_FIRST_STARTS)
def stream_first_starts(spark: SparkSession, folder: str) -> DataFrame:
    starts = jobs.start_table(new_work_dir(spark, "starts"))
    raw = standins.raw_logs(_stream(spark, folder, "events"))
    jobs.run_first_starts(
        diversion.divert(raw, only=diversion.START), starts,
        new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED, on_count=lambda *_: None,
    ).awaitTermination()
    return jobs.first_start_view(spark, starts).select(
        "id", "mid", "uid", "ts", "start_date", "start_time"
    )


@query(_FIRST_STARTS)
def stream_first_starts_state(spark: SparkSession, folder: str) -> DataFrame:
    """First starts with the seen devices as state that expires."""
    starts = jobs.first_start_table(new_work_dir(spark, "starts"))
    raw = standins.raw_logs(_stream(spark, folder, "events"))
    with _state_tasks(spark):
        jobs.run_first_starts_state(
            diversion.divert(raw, only=diversion.START), starts, new_work_dir(spark, "checkpoint"), trigger=jobs.UNTIL_DRAINED,
        ).awaitTermination()
    return jobs.first_start_view(spark, starts).select("id", "mid", "uid", "ts", "start_date", "start_time")


@query(f"""
  with b as (
    select 'mid_' || (user_id % 40) mid, {_MS} ms, strftime({_LOCAL}, '%Y-%m-%d') start_date,
      floor((place - low) / ceil((high - low + 1) / n)) b
    from (select *, min(place) over () low, max(place) over () high, greatest({SLICES}, ceil(count(*) over () / {SLICE_ROWS})) n
      from (select *, event_id + case when event_id % 50 = 7 then (select max(event_id) // 2 from events) else 0 end place
        from events where event_type = 'signup'))),
  m as (select b, max(start_date::date) high from b group by 1)
  select mid, ms ts, start_date, false ahead
  from b where start_date::date < (select max(high) from m where m.b < b.b) - 1""")
def stream_outside_starts(spark: SparkSession, folder: str) -> DataFrame:
    """Starts of dates that are closed: every fiftieth comes half the table too late."""
    events = standins.events_of(spark, folder)
    half = (events.agg(F.max("event_id")).first()[0] or 0) // 2
    place = F.col("event_id") + F.when(F.col("event_id") % 50 == 7, half).otherwise(0)
    rows = standins.start_rows(events.withColumn("place", place), "place")
    messages = _sliced(rows.select(F.to_json(F.struct("mid", "uid", "ts")).alias("value"), "place"), F.col("place"), each=True)
    outside = jobs.outside_start_table(new_work_dir(spark, "outside"))
    jobs.run_outside_starts(
        messages, outside, jobs.mark_table(new_work_dir(spark, "marks")), new_work_dir(spark, "checkpoint"),
        trigger=jobs.UNTIL_DRAINED).awaitTermination()
    return outside.read(spark).select("mid", "ts", "start_date", "ahead")


def _spoiled_sql(where: str, devices: int, action: str) -> str:
    return f"""
  select 'mid_' || (user_id % {devices}) mid, user_id::varchar uid, {_K} k, {action} action_id,
    case when {_K}::int >= 90 then 'soon' end ts
  from events where {where} and ({_K}::int >= 90 or {_K}::int < 10)"""


def _kept_texts(aside: DataFrame, k: str) -> DataFrame:
    names = {"mid": "mid", "uid": "uid", "k": k, "action_id": "action_id", "ts": "ts"}
    return aside.select(*[F.get_json_object("value", f"$.{field}").alias(name) for name, field in names.items()])


@query(_spoiled_sql("event_type = 'signup'", 40, "null::varchar"))
def stream_starts_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """Start messages without a readable time, as the job of first starts keeps them aside."""
    messages = standins.spoiled_messages(standins.start_rows(_stream(spark, folder, "events")))
    aside = jobs.unreadable_table(new_work_dir(spark, "unreadable"))
    jobs.run_first_starts(
        messages, jobs.start_table(new_work_dir(spark, "starts")), new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED,
        on_unreadable=aside.write).awaitTermination()
    return _kept_texts(aside.read(spark), "loading_time")


@query(_spoiled_sql("true", 5, "event_type"))
def stream_actions_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """Actions without a readable time, as the action log keeps them aside."""
    messages = standins.spoiled_messages(standins.action_rows(_stream(spark, folder, "events")))
    aside = jobs.unreadable_table(new_work_dir(spark, "unreadable"))
    jobs.run_action_log(
        messages, jobs.action_table(new_work_dir(spark, "actions")), new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED,
        on_unreadable=aside.write).awaitTermination()
    return _kept_texts(aside.read(spark), "item")


# Sales totals ------------------------------------------------------------------------------


@query(_GMV_HOURS)
def gmv_by_date_hour(spark: SparkSession, folder: str) -> DataFrame:
    bought = standins.purchases(standins.events_of(spark, folder))
    return _gmv_output(gmv.hourly_totals(bought, "ts", "value"))


@query(_GMV_HOURS)
def gmv_from_messages(spark: SparkSession, folder: str) -> DataFrame:
    messages = standins.order_messages(standins.events_of(spark, folder))
    return _gmv_output(gmv.partial_totals(gmv.readable(gmv.parse_orders(messages, fields=[]))))


@query(f"""
  with o as (
    select event_id::varchar id, {_K}::int k, strftime(ts, '%Y-%m-%d %H:%M:%S') created
    from events where event_type = 'purchase')
  select id, case when k >= 90 then 'yesterday' else created end create_time
  from o where k >= 90 or k < 10""")
def gmv_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    messages = standins.spoiled_order_messages(standins.events_of(spark, folder))
    return gmv.unreadable(gmv.parse_orders(messages)).select("id", "create_time")


@query(_GMV_HOURS)
def gmv_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Sums per arrival batch (six hours each), then the additive fold of the batches."""
    bought = standins.purchases(standins.events_of(spark, folder))
    batches = bought.withColumn("batch_id", times.floor_div(times.epoch_ms("ts"), 6 * 3600 * 1000))
    return _gmv_output(gmv.fold_totals(gmv.hourly_totals(batches, "ts", "value", "batch_id")))


@query(_GMV_HOURS)
def stream_gmv(spark: SparkSession, folder: str) -> DataFrame:
    ledger = jobs.gmv_table(new_work_dir(spark, "gmv"))
    messages = standins.order_messages(_stream(spark, folder, "events"))
    jobs.run_gmv(
        messages, ledger, new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED
    ).awaitTermination()
    return _gmv_output(jobs.gmv_view(spark, ledger))


# Keyed replace -----------------------------------------------------------------------------


@query("""
  select user_id, event_type, event_id from events
  qualify row_number() over (partition by user_id order by event_id desc) = 1""")
def replace_upsert(spark: SparkSession, folder: str) -> DataFrame:
    rows = standins.events_of(spark, folder).select("user_id", "event_type", "event_id")
    return last_per_key(rows, ["user_id"], ["event_id"])


@query("""
  select o_custkey, o_orderkey, o_orderstatus,
         strftime(o_orderdate, '%Y-%m-%d') batch_day, o_totalprice::decimal(16,2)::double amount
  from orders
  qualify row_number() over (
    partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""")
def keyed_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Whole-row upsert: the row of the last batch (order day) wins per key."""
    rows = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", times.date_of("o_orderdate").alias("batch_day"),
        F.col("o_totalprice").cast(MONEY).cast("double").alias("amount"),
    )
    return last_per_key(rows, ["o_custkey"], ["batch_day", "o_orderkey"])


@query("""
  select (user_id % 8)::bigint partition_id, max(event_id) "offset"
  from events where event_type = 'purchase' group by 1""")
def offsets_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Stored positions: group and topic are constants, each event stores one position."""
    rows = standins.events_of(spark, folder).select(
        F.lit("orderInfo").alias("group_id"), F.col("event_type").alias("topic"),
        (F.col("user_id") % 8).alias("partition_id"), F.col("event_id").alias("offset"),
    )
    return saved_offsets(rows, "orderInfo", "purchase")


# Alerts ------------------------------------------------------------------------------------

RULE = alerts.AlertRule(trigger="signup", item_action="click")

_ALERTS = f"""
  with e as (
    select 'mid_' || (user_id % 5) mid, user_id::varchar uid, event_type a, {_K} item, {_MS} ms
    from events),
  w as (
    select e.*, (ms // 30000 + 1 + i) * 30000 window_end from e, range(10) r(i)),
  suspects as (
    select mid, window_end, uid from w group by all having bool_or(a = 'signup')),
  windows as (
    select mid, window_end, count(*) users from suspects group by all having count(*) >= 2),
  hits as (
    select w.*, users from w join suspects using (mid, window_end, uid)
    join windows using (mid, window_end)),
  minutes as (
    select mid, strftime(make_timestamp(window_end * 1000) + interval 8 hour, '%Y-%m-%dT%H:%M')
             || '_' || mid id, max(window_end) window_end
    from windows group by all),
  documents as (
    select mid, window_end, users, 'event' kind, uid, item, a action_id, ms ts from hits
    union all select distinct mid, window_end, users, 'user', uid, null, null, null from hits
    union all select distinct mid, window_end, users, 'item', null, item, null, null from hits where a = 'click')"""


def _alert_output(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(*extra, "mid", "window_end", "users", "kind", "uid", "item", "action_id", "ts")


@query(f"{_ALERTS} select mid, window_end, users from windows")
def alert_devices(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.alert_windows(standins.action_rows(standins.events_of(spark, folder)), RULE)


@query(f"{_ALERTS} select mid, window_end, users, uid, ms ts, a action_id, item from hits")
def alert_events(spark: SparkSession, folder: str) -> DataFrame:
    actions = standins.action_rows(standins.events_of(spark, folder))
    return alerts.alert_events(actions, alerts.alert_windows(actions, RULE), RULE)


@query(f"{_ALERTS} select * from documents")
def alert_window(spark: SparkSession, folder: str) -> DataFrame:
    actions = standins.action_rows(standins.events_of(spark, folder))
    return _alert_output(alerts.alert_rows(actions, rule=RULE))


@query(f"""{_ALERTS} select m.id, w.mid, w.window_end, w.users
  from windows w join minutes m using (mid, window_end)""")
def alert_minute_latest(spark: SparkSession, folder: str) -> DataFrame:
    actions = standins.action_rows(standins.events_of(spark, folder))
    latest = alerts.latest_per_minute(alerts.alert_windows(actions, RULE))
    return latest.select("id", "mid", "window_end", "users")


_MINUTE_ROWS = f"{_ALERTS} select m.id, d.* from documents d join minutes m using (mid, window_end)"


@query(_MINUTE_ROWS)
def alert_minute_documents(spark: SparkSession, folder: str) -> DataFrame:
    actions = standins.action_rows(standins.events_of(spark, folder))
    latest = alerts.latest_per_minute(alerts.alert_windows(actions, RULE)).drop("id")
    return _alert_output(alerts.alert_rows(actions, latest, RULE), "id")


# Orders and lines --------------------------------------------------------------------------

AS_OF = "2024-01-01"

_SALES = f"""
  with u as (
    select *, date '1960-01-01' + (c_custkey % 15000)::int birthday
    from customer where c_acctbal >= 0)
  select l_orderkey || '-' || l_linenumber || '-' || l_partkey order_detail_id,
    o_orderkey::varchar order_id, o_orderstatus order_status,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') create_time, o_custkey::varchar user_id,
    l_partkey::varchar sku_id,
    case when c_nationkey < 12 then 'F' when c_nationkey >= 12 then 'M' end user_gender,
    coalesce((date '{AS_OF}' - birthday) // 365, 0)::int user_age, c_mktsegment user_level,
    l_extendedprice::decimal(16,2)::double sku_price, p_name sku_name, l_quantity::int sku_num,
    strftime(o_orderdate, '%Y-%m-%d') dt, (o_custkey % 27)::varchar province_id,
    n_name province_name, n_regionkey::varchar region_id, 'ISO-' || n_nationkey iso_code,
    'CN-' || n_nationkey iso_3166_2,
    case when n_nationkey is null then 'unknown_province' else 'ok' end status
  from lineitem join orders on l_orderkey = o_orderkey
  left join u on c_custkey = o_custkey
  left join nation on n_nationkey = o_custkey % 27
  left join part on p_partkey = l_partkey"""


def _sale_rows(spark: SparkSession, folder: str) -> DataFrame:
    headers = gmv.readable(gmv.with_order_fields(
        standins.order_headers(table(spark, folder, "orders"))
    ))
    lines = standins.order_lines(table(spark, folder, "lineitem"), table(spark, folder, "part"))
    return sales.sale_details(
        headers, lines, standins.users(table(spark, folder, "customer")),
        standins.provinces(table(spark, folder, "nation")), F.lit(AS_OF),
    )


@query(_SALES)
def sale_detail_wide(spark: SparkSession, folder: str) -> DataFrame:
    return _sale_rows(spark, folder)


@query(f"""select province_id, count(*) lines, sum(sku_num)::bigint pieces from ({_SALES})
  where status = 'unknown_province' group by 1""")
def sale_unknown_province(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sale_rows(spark, folder).filter(F.col("status") == sales.UNKNOWN_PROVINCE)
    return rows.groupBy("province_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("sku_num").alias("pieces")
    )


def _day(column: str) -> Column:
    return F.unix_date(F.col(column).cast("date"))


@query("""
  select case when l_orderkey is null then 'info_only' when o_orderkey is null then 'early_detail'
         else 'matched' end state, count(*) cnt
  from orders full join lineitem on o_orderkey = l_orderkey
    and l_shipdate between o_orderdate - interval 30 day and o_orderdate + interval 30 day
  group by 1""")
def order_pairing_states(spark: SparkSession, folder: str) -> DataFrame:
    headers = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), _day("o_orderdate").alias("order_at")
    )
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), _day("l_shipdate").alias("detail_at")
    )
    return pairing.pairing_states(headers, lines, 30)


@query("""
  select o_orderkey order_id, o_orderstatus order_status, l_linenumber line_no, l_partkey sku_id,
         date_diff('day', o_orderdate, l_shipdate) day_gap
  from orders join lineitem on o_orderkey = l_orderkey
    and l_shipdate between o_orderdate - interval 30 day and o_orderdate + interval 30 day""")
def order_pairs(spark: SparkSession, folder: str) -> DataFrame:
    headers = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_ts"),
    )
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("sku_id"), F.col("l_shipdate").alias("detail_ts"),
    )
    gap = (_day("detail_ts") - _day("order_ts")).cast("bigint").alias("day_gap")
    return pairing.pair_orders(headers, lines, "30 days").select(
        "order_id", "order_status", "line_no", "sku_id", gap
    )


@query("""
  select a.user_id, a.event_id signup_id, b.event_id click_id
  from events a join events b on a.user_id = b.user_id
    and b.ts between a.ts - interval 5 minute and a.ts + interval 5 minute
  where a.event_type = 'signup' and b.event_type = 'click'""")
def interval_join(spark: SparkSession, folder: str) -> DataFrame:
    events = standins.events_of(spark, folder)
    return intervals.interval_pairs(
        standins.timed(events, "signup", "signup_id", "signup_at"),
        standins.timed(events, "click", "click_id", "click_at"),
        ["user_id"], "signup_at", "click_at", 5 * 60 * 1_000_000,
    ).select("user_id", "signup_id", "click_id")


@query("""
  select event_id from events a where event_type = 'signup' and not exists (
    select 1 from events b where b.event_type = 'click' and a.user_id = b.user_id
      and b.ts between a.ts - interval 5 minute and a.ts + interval 5 minute)""")
def interval_unpaired(spark: SparkSession, folder: str) -> DataFrame:
    events = standins.events_of(spark, folder)
    return intervals.without_partner(
        standins.timed(events, "signup", "event_id", "signup_at"),
        standins.timed(events, "click", "click_id", "click_at"),
        ["user_id"], "signup_at", "click_at", 5 * 60 * 1_000_000,
    ).select("event_id")


@query(f"""
  select c_custkey, ((date '{AS_OF}' - (date '1960-01-01' + (c_custkey % 15000)::int)) // 365)::int
    user_age from customer""")
def user_age(spark: SparkSession, folder: str) -> DataFrame:
    birthday = F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int"))
    return table(spark, folder, "customer").select(
        "c_custkey", times.age_in_years(birthday, F.lit(AS_OF)).alias("user_age")
    )


@query(f"""
  select event_id, strftime({_LOCAL}, '%Y-%m-%d') local_date, strftime({_LOCAL}, '%H') local_hour,
    strftime({_LOCAL}, '%Y-%m-%dT%H:%M') local_minute,
    strftime({_LOCAL}, '%Y-%m-%dT%H:%M:%S') local_second
  from events""")
def time_parts(spark: SparkSession, folder: str) -> DataFrame:
    local = standins.events_of(spark, folder).select(
        "event_id", times.local_time(times.epoch_ms("ts")).alias("at")
    )
    return local.select(
        "event_id", times.date_of("at").alias("local_date"), times.hour_of("at").alias("local_hour"),
        times.minute_of("at").alias("local_minute"), times.second_of("at").alias("local_second"),
    )


# Row changes -------------------------------------------------------------------------------

_CHANGES = """
  with c as (
    select case when o_orderkey % 4 = 0 then 'user_info' when o_orderkey % 4 = 1
             then 'order_detail' else 'order_info' end tbl,
           case when o_orderkey % 5 = 0 then 'DELETE' when o_orderkey % 5 <= 2 then 'UPDATE'
             else 'INSERT' end op,
           o_orderkey seq, epoch_us(o_orderdate) // 1000 ts, pos::int pos,
           (o_custkey + pos)::varchar id, o_orderstatus user_level,
           '{"id":"' || (o_custkey + pos) || '","user_level":"' || o_orderstatus || '"}' "value"
    from orders, range(2) r(pos) where o_orderpriority <> '5-LOW'),
  routed as (
    select *, case when tbl = 'order_info' and op = 'INSERT' then 'REALTIME_DB_ORDER_INFO'
      when tbl = 'order_detail' and op = 'INSERT' then 'REALTIME_DB_ORDER_DETAIL'
      when tbl = 'user_info' and op in ('INSERT', 'UPDATE') then 'user_info' end target
    from c),
  latest as (
    select * from routed where target = 'user_info'
    qualify row_number() over (partition by id order by seq desc, pos desc) = 1)"""
NOW_MS = 983_404_800_000


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    return standins.row_changes(table(spark, folder, "orders"))


@query(f"""{_CHANGES} select seq, pos, "value" from routed
  where target = 'REALTIME_DB_ORDER_INFO'""")
def cdc_order_inserts(spark: SparkSession, folder: str) -> DataFrame:
    routed = changes.route_changes(_changes(spark, folder))
    return routed.filter(F.col("target") == changes.ORDER_INFO_TOPIC).select("seq", "pos", "value")


@query(f"{_CHANGES} select target, count(*) cnt from routed where target is not null group by 1")
def cdc_route(spark: SparkSession, folder: str) -> DataFrame:
    return changes.route_changes(_changes(spark, folder)).groupBy("target").agg(
        F.count(F.lit(1)).alias("cnt")
    )


@query(f"""{_CHANGES} select target topic, "value" from routed where target <> 'user_info'""")
def cdc_topic_rows(spark: SparkSession, folder: str) -> DataFrame:
    return changes.topic_rows(_changes(spark, folder))


@query(f"""{_CHANGES} select id, seq, pos, ts, "value" from latest""")
def cdc_latest_user(spark: SparkSession, folder: str) -> DataFrame:
    return changes.latest_users(changes.user_rows(_changes(spark, folder)))


@query(f"""{_CHANGES} select id, seq from latest where ts > {NOW_MS} - 7 * 86400000""")
def cdc_live_users(spark: SparkSession, folder: str) -> DataFrame:
    """Users whose last write lies within the week before 2001-03-01 or later."""
    latest = changes.latest_users(changes.user_rows(_changes(spark, folder)))
    return changes.unexpired(latest, NOW_MS).select("id", "seq")


@query(f"""{_CHANGES} select target topic, "value" from routed where target <> 'user_info'""")
def stream_change_topics(spark: SparkSession, folder: str) -> DataFrame:
    out = new_work_dir(spark, "change-topics")
    jobs.run_change_topics(
        standins.row_changes(_stream(spark, folder, "orders")),
        lambda rows: sinks.folder_writer(rows, out),
        new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED,
    ).awaitTermination()
    return spark.read.schema("value string, topic string").text(out)


@query(f"""{_CHANGES} select id, user_level from latest where ts > {NOW_MS} - 7 * 86400000""")
def stream_user_state(spark: SparkSession, folder: str) -> DataFrame:
    state = jobs.user_table(new_work_dir(spark, "users"))
    jobs.run_user_state(
        standins.row_changes(_stream(spark, folder, "orders", thirds=True)), state,
        new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED,
    ).awaitTermination()
    return jobs.user_view(spark, state, NOW_MS).select("id", "user_level")


# Words -------------------------------------------------------------------------------------


def _words_sql(name: str) -> str:
    return f"""
      select word, count(*) cnt from (
        select unnest(case when rtrim(text, ' ') = '' and text <> '' then []
                      else string_split(rtrim(text, ' '), ' ') end) word from {name}) group by 1"""


def _word_counts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return words.word_counts(table(spark, folder, name), "text")


@query(_words_sql("documents"))
def wordcount(spark: SparkSession, folder: str) -> DataFrame:
    return _word_counts(spark, folder, "documents")


@query(_words_sql("documents"))
def stream_wordcount(spark: SparkSession, folder: str) -> DataFrame:
    ledger = jobs.word_table(new_work_dir(spark, "words"))
    lines = _stream(spark, folder, "documents").select(F.col("text").alias("value"))
    jobs.run_word_counts(
        lines, ledger, new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED
    ).awaitTermination()
    return jobs.word_view(spark, ledger)


def _register_word_joins() -> None:
    for how in ("inner", "left", "right", "full"):

        def joined(spark: SparkSession, folder: str, how: str = how) -> DataFrame:
            return words.join_counts(
                _word_counts(spark, folder, "documents"),
                _word_counts(spark, folder, "benchmark"), how,
            )

        joined.__name__ = f"wordcount_join_{how}"
        query(f"""
          select coalesce(d.word, b.word) word, d.cnt left_cnt, b.cnt right_cnt
          from ({_words_sql("documents")}) d {how} join ({_words_sql("benchmark")}) b
          on d.word = b.word""")(joined)


_register_word_joins()


# Streams over the test tables --------------------------------------------------------------

BATCH_SLICES = 20
BATCH_FILES, FILE_ROWS = 12, 8_000
LANES, LANE_BATCHES = 4, 4
STATE_TASKS = 64


#: A query that runs once to its end needs no older states than the last one's, nor shuffle files of batches that
#: are done: both are kept by default (100 states; shuffle files until the driver collects its garbage).
FRESH_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
FRESH_STATE = {
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}


@contextmanager
def _with_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    asked = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in asked.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def _state_tasks(spark: SparkSession) -> Iterator[None]:
    """Queries with state that start in here have at most `STATE_TASKS` partitions. Each of their tasks reports on all
    partitions and writes a state file per batch; a batch holds up to 20 slices however large the input is, so partitions
    that grow with the input as well would make these costs grow with its square or more."""
    name = "spark.sql.shuffle.partitions"
    with _with_conf(spark, {name: str(min(int(spark.conf.get(name)), STATE_TASKS))}):
        yield


def _sliced(rows: DataFrame, order: Column, each: bool = False, thirds: bool = False) -> DataFrame:
    """All rows as a stream in the given order: see `_sliced_together`."""
    return _sliced_together([(rows, order)], each, thirds=thirds)[0]


def _lanes(spark: SparkSession, folder: str, name: str) -> list[tuple[int, DataFrame]]:
    """(first slice, stream): all rows of a table, each batch one slice, as streams of consecutive slices.

    For jobs without state, whose batches do not need each other: most of what a batch of one slice costs is
    waiting (plans, commits, logs of the checkpoint), so streams run side by side. There is one for every
    `LANE_BATCHES` slices and at most `LANES`.
    """
    batches, [dealt] = _dealt([(table(spark, folder, name), _order(name))], each=True)
    return _in_turn(dealt, batches, max(1, min(LANES, batches // LANE_BATCHES)))


def _sliced_together(
    sides: Sequence[tuple[DataFrame, Column]], each: bool = False, pace: int | None = None, thirds: bool = False,
    spent: bool = False,
) -> list[DataFrame]:
    """Streams of all rows of each side in its order; their batches span the same values of the orders.

    There are at least three slices of equal span, and more where that would put over 100,000 rows into one. A
    batch is one slice with `each`, else as many as make up 20 times that number of rows, or a third of all: much
    of what a batch costs does not depend on its rows. With `thirds` it is a third of all at any size, for a job without
    state whose batches each rewrite a table that grows with the input. `pace` names the side whose rows are counted;
    all are without it.

    Rows are written twice, dealt by batch and then batch after batch, because a stream takes files by age. With `spent`
    the first copy goes as it is written again and a stream's files go as its batches end: only one query may read it, once.
    Rows without an order value are in the first slice; an empty table gives a stream without rows.
    """
    batches, dealt = _dealt(sides, each, pace, thirds)
    return [_in_turn(rows, batches, spent=spent)[0][1] for rows in dealt]


def _dealt(
    sides: Sequence[tuple[DataFrame, Column]], each: bool = False, pace: int | None = None, thirds: bool = False,
) -> tuple[int, list[DataFrame]]:
    """Number of batches, and the rows of each side with their `_batch`."""
    counted = [order.cast("bigint").alias("_at") for _, order in sides]
    paced = [rows.select(at) for (rows, _), at in zip(sides, counted)][slice(pace, None if pace is None else pace + 1)]
    ats = reduce(DataFrame.unionByName, paced)
    n, low, high = ats.agg(F.count("*"), F.min("_at"), F.max("_at")).first()
    count = max(SLICES, -(-n // SLICE_ROWS))
    size = -(-((high or 0) - (low or 0) + 1) // count)
    place = times.floor_div(F.col("_at") - F.lit(low or 0), size)
    number = F.greatest(F.lit(0), F.least(F.lit(count - 1), F.coalesce(place, F.lit(0)))).cast("int")
    batch_of = list(range(count))
    if not each and count > SLICES:
        held = dict(ats.groupBy(number.alias("slice")).count().collect())
        third = -(-n // SLICES)
        batch_of = _batches_of([held.get(i, 0) for i in range(count)], third if thirds else min(BATCH_SLICES * SLICE_ROWS, third))
    batch = F.get(F.lit(batch_of), number) if batch_of != list(range(count)) else number
    return batch_of[-1] + 1, [rows.withColumn("_at", at).withColumn("_batch", batch).drop("_at")
                              for (rows, _), at in zip(sides, counted)]


def _batches_of(held: Sequence[int], full: int) -> list[int]:
    """The batch of each slice. A slice that lies more than half above `full` rows begins a batch."""
    found, batch, rows = [], 0, 0
    for n in held:
        if rows and rows + n / 2 > full:
            batch, rows = batch + 1, 0
        found.append(batch)
        rows += n
    return found


def _in_turn(rows: DataFrame, batches: int, lanes: int = 1, spent: bool = False) -> list[tuple[int, DataFrame]]:
    """(first batch, stream): rows with a `_batch` as streams that each take their share of the batches, one after
    the other."""
    spark = rows.sparkSession
    schema = rows.drop("_batch").schema
    none = spark.createDataFrame([], schema)
    dealt = new_work_dir(spark, "dealt")
    with _with_conf(spark, FRESH_SHUFFLES):
        # In files of a slice, so that each batch is read by many tasks when it is written again.
        rows.hint("rebalance", "_batch").write.option("maxRecordsPerFile", SLICE_ROWS).partitionBy("_batch").parquet(dealt)
        held = dict(spark.read.schema(rows.schema).parquet(dealt).groupBy("_batch").count().collect())
        # A batch is read by as many tasks as it has files. Its rows are dealt to them in turn, so with a thousand
        # rows a file none is left out. The last batch may have fewer. Lanes share the tasks.
        most = max(held.values(), default=0)
        files = max(-(-most // SLICE_ROWS), min(-(-BATCH_FILES // lanes), most // FILE_ROWS))
        files = max(1, min([files, *(held.get(b, 0) // 1000 for b in range(batches - 1))]))
        firsts = [lane * batches // lanes for lane in range(lanes)]
        paths = [new_work_dir(spark, "slices") for _ in firsts]

        def put(first: int, end: int, path: str) -> None:
            for number in range(first, end):
                own = f"{dealt}/_batch={number}"
                part = spark.read.schema(schema).parquet(own) if number in held else none
                part = part.repartition(files) if files > 1 else part.coalesce(1)
                part.write.mode("append").parquet(path)
                if spent and number in held:
                    none.write.mode("overwrite").parquet(own)

        with ThreadPoolExecutor(lanes) as pool:
            list(pool.map(put, firsts, [*firsts[1:], batches], paths))
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    if spent:
        reader = reader.option("cleanSource", "delete")
    return [(first, reader.parquet(path)) for first, path in zip(firsts, paths)]


def _order(name: str) -> Column:
    return {"events": F.col("event_id"), "orders": F.unix_date(F.col("o_orderdate").cast("date")), "documents": F.col("doc_id"),
            "benchmark": F.col("item_id")}[name]


def _stream(spark: SparkSession, folder: str, name: str, each: bool = False, thirds: bool = False) -> DataFrame:
    return _sliced(table(spark, folder, name), _order(name), each, thirds)


@query(_MINUTE_ROWS)
def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of all events, decided in the stream, with their actions from the action log's table; one later
    trigger closes the last windows."""
    actions = standins.action_rows(standins.events_of(spark, folder))
    close = actions.agg((F.max("ts") + 3_600_000).alias("ts")).select(
        F.lit("z").alias("mid"), F.lit("z").alias("uid"), F.lit(RULE.trigger).alias("action_id"),
        F.lit(None).cast("string").alias("item"), "ts")
    messages = _sliced(actions.unionByName(close).select(F.to_json(F.struct("*")).alias("value"), "ts"), F.col("ts"))
    kept = jobs.action_table(new_work_dir(spark, "actions"))
    jobs.run_action_log(messages, kept, new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED).awaitTermination()
    alert_table = jobs.alert_table(new_work_dir(spark, "alerts"))
    with _state_tasks(spark):
        jobs.run_alerts(
            messages, lambda s, from_ms, to_ms: jobs.actions_between(s, kept, from_ms, to_ms), alert_table,
            new_work_dir(spark, "checkpoint"), RULE, jobs.UNTIL_DRAINED, on_count=lambda *_: None,
        ).awaitTermination()
    return _alert_output(jobs.alert_view(spark, alert_table), "id")


@query(f"{_ALERTS} select mid, window_end, users from windows")
def stream_alerts_early(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts as known when all events were read, without waiting for any window to close."""
    actions = standins.action_rows(standins.events_of(spark, folder))
    messages = actions.select(F.to_json(F.struct("*")).alias("value"), "ts")
    found = jobs.suspect_table(new_work_dir(spark, "suspects"))
    messages = _sliced(messages, F.col("ts"))
    with _state_tasks(spark):
        jobs.run_early_alerts(messages, found, new_work_dir(spark, "checkpoint"), RULE, jobs.UNTIL_DRAINED).awaitTermination()
    return jobs.early_alert_view(spark, found, RULE).select("mid", "window_end", "users")


def _without_partner(kind: str, one: str, other: str) -> str:
    return f"""
  select '{kind}' kind, event_id from events a where event_type = '{one}' and not exists (
    select 1 from events b where b.event_type = '{other}' and a.user_id = b.user_id
      and b.ts between a.ts - interval 5 minute and a.ts + interval 5 minute)"""


@query(f"""{_without_partner("info_only", "signup", "click")} union all {_without_partner("early_detail", "click", "signup")}""")
def stream_unpaired(spark: SparkSession, folder: str) -> DataFrame:
    """Sign-ups as headers and clicks as lines of a user's order: those that were never paired."""
    events = standins.events_of(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    # A header and a line far behind all others are each other's partner and move the watermark.
    end = events.agg((F.max("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts")).select("ts", F.lit("z").alias("order_id"), F.lit(-1).cast("bigint").alias("event_id"))

    def side(event_type: str, time: str) -> tuple[DataFrame, Column]:
        rows = events.filter(F.col("event_type") == event_type).select("ts", F.col("user_id").cast("string").alias("order_id"), "event_id")
        return rows.unionByName(end).withColumnRenamed("ts", time), F.unix_micros(time)

    headers, lines = _sliced_together([side("signup", "order_ts"), side("click", "detail_ts")])
    lost = jobs.unpaired_table(new_work_dir(spark, "unpaired"))
    with _state_tasks(spark):
        jobs.run_unpaired(
            headers, lines, lost, new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED,
            headers_once=False).awaitTermination()
    return lost.read(spark).select("kind", F.get_json_object("row", "$.event_id").cast("bigint").alias("event_id"))


@query(f"""
  with p as (
    select event_id, ts, event_id + case when event_id % 50 = 7 then (select max(event_id) // 2 from events) else 0 end place from events),
  b as (
    select event_id, ts, floor((place - low) / ceil((high - low + 1) / n)) b
    from p, (select min(place) low, max(place) high, greatest({SLICES}, ceil(count(*) / {SLICE_ROWS})) n from p)),
  m as (select b, max(ts) high from b group by 1)
  select event_id from b where ts < (select max(high) from m where m.b < b.b) - interval 5 minute""")
def stream_late(spark: SparkSession, folder: str) -> DataFrame:
    """Events that arrive behind the watermark: every fiftieth comes half the table too late."""
    events = standins.events_of(spark, folder).withColumn("ts", F.col("ts").cast("timestamp")).select("event_id", "ts")
    half = events.agg(F.max("event_id")).first()[0] // 2
    place = F.col("event_id") + F.when(F.col("event_id") % 50 == 7, half).otherwise(0)
    late = jobs.BatchTable(new_work_dir(spark, "late"), "event_id bigint, ts timestamp")
    jobs.run_late_rows(
        _sliced(events, place, each=True), "ts", late, jobs.mark_table(new_work_dir(spark, "marks")), new_work_dir(spark, "checkpoint"),
        jobs.UNTIL_DRAINED).awaitTermination()
    return late.read(spark).select("event_id")


@query(_GMV_HOURS)
def stream_gmv_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly totals of a job that lost its checkpoint half-way and started again from the stored positions."""
    events = standins.events_of(spark, folder)
    half = (events.agg(F.max("event_id")).first()[0] or 0) // 2
    placed = (F.lit("orders").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"))
    messages = standins.purchases(events).select(*placed, "event_id", "ts", "user_id", "event_type", "value", "props")
    rows = messages.select("topic", "partition", "offset", F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"), F.substring(F.col("ts").cast("string"), 1, 19).alias("create_time"),
        F.col("value").cast(MONEY).cast("string").alias("total_amount"))).alias("value"))
    root = new_work_dir(spark, "ledger")
    first, second = (jobs.ledger_table(root, run) for run in ("first", "second"))
    jobs.run_gmv_ledger(_sliced(rows.filter(F.col("offset") <= half), F.col("offset")), first, new_work_dir(spark, "checkpoint"),
                        trigger=jobs.UNTIL_DRAINED).awaitTermination()
    jobs.run_gmv_ledger(_sliced(rows, F.col("offset")), second, new_work_dir(spark, "checkpoint"),
                        jobs.ledger_positions(spark, first), jobs.UNTIL_DRAINED).awaitTermination()
    return _gmv_output(jobs.ledger_view(spark, first, second))


def _repeated_orders(spark: SparkSession, folder: str) -> DataFrame:
    sent = standins.repeated_order_messages(standins.events_of(spark, folder), "10 minutes")
    return _sliced(sent, F.unix_micros("arrived"))


@query(_GMV_HOURS)
def stream_gmv_once(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly totals where a third of the messages is sent twice, with the ids they had."""
    ledger = jobs.gmv_table(new_work_dir(spark, "gmv"))
    messages = once(_repeated_orders(spark, folder), "1 hour")
    with _state_tasks(spark):
        jobs.run_gmv(messages, ledger, new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED).awaitTermination()
    return _gmv_output(jobs.gmv_view(spark, ledger))


@query(_GMV_HOURS)
def stream_gmv_orders_once(spark: SparkSession, folder: str) -> DataFrame:
    """The same where only the order ids tell."""
    ledger = jobs.gmv_table(new_work_dir(spark, "gmv"))
    messages = _repeated_orders(spark, folder)
    with _state_tasks(spark):
        jobs.run_gmv(
            messages, ledger, new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED, once_within="1 hour",
        ).awaitTermination()
    return _gmv_output(jobs.gmv_view(spark, ledger))


@query(_GMV_HOURS)
def stream_gmv_state(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly totals held as state of the query and read from its checkpoint."""
    checkpoint = new_work_dir(spark, "checkpoint")
    messages = standins.order_messages(_stream(spark, folder, "events"))
    with _state_tasks(spark):
        jobs.run_gmv_state(messages, checkpoint, jobs.UNTIL_DRAINED).awaitTermination()
    return _gmv_output(jobs.gmv_state_view(spark, checkpoint))


# Order lines that share an id replace each other; of one batch the larger row stays.
@query(f"""select * from ({_SALES})
  qualify row_number() over (partition by order_detail_id order by sku_price desc, sku_num desc) = 1""")
def stream_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Headers and lines of all orders arriving together, some amounts unreadable."""
    headers = standins.order_headers(table(spark, folder, "orders"))
    arrived = F.to_timestamp("create_time").alias("arrived")
    spoiled = F.when(F.col("id").cast("bigint") % 7 == 0, F.lit("n/a")).otherwise(F.col("total_amount"))
    orders = headers.withColumn("total_amount", spoiled).select(
        F.to_json(F.struct("*")).alias("value"), arrived)
    lines = standins.order_lines(table(spark, folder, "lineitem"), table(spark, folder, "part"))
    times_ = headers.select(F.col("id").alias("order_id"), arrived)
    details = lines.join(times_, "order_id").select(
        F.to_json(F.struct(*lines.columns)).alias("value"), "arrived")
    # A header comes with its lines, so neither waits long as state; lines are counted, at the times of their headers.
    orders, details = _sliced_together([(orders, F.unix_seconds("arrived")), (details, F.unix_seconds("arrived"))], pace=1, spent=True)
    sale_table = jobs.sale_table(new_work_dir(spark, "sales"), by=["status"])  # years of days in a batch
    with _state_tasks(spark), _with_conf(spark, FRESH_SHUFFLES | FRESH_STATE):
        jobs.run_sales(
            orders, details,
            lambda s: standins.users(table(s, folder, "customer")),
            lambda s: standins.provinces(table(s, folder, "nation")),
            sale_table, new_work_dir(spark, "checkpoint"), F.lit(AS_OF), jobs.UNTIL_DRAINED,
        ).awaitTermination()
    rows = jobs.sale_view(spark, sale_table).unionByName(jobs.sale_view(spark, sale_table, sales.UNKNOWN_PROVINCE))
    return rows.select(*SALE_DETAIL_COLUMNS, "status")


@query("""
  select event_id::varchar id,
    case when json_extract_string(props, '$.k')::int >= 90 then 'yesterday'
         else strftime(ts, '%Y-%m-%d %H:%M:%S') end create_time
  from events where event_type = 'purchase'
    and (json_extract_string(props, '$.k')::int >= 90 or json_extract_string(props, '$.k')::int < 10)""")
def stream_gmv_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that the sales total cannot use, as its job keeps them aside."""
    messages = standins.spoiled_order_messages(_stream(spark, folder, "events"))
    aside = jobs.unreadable_order_table(new_work_dir(spark, "unreadable"))
    jobs.run_gmv(
        messages, jobs.gmv_table(new_work_dir(spark, "gmv")), new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED,
        on_unreadable=aside.write,
    ).awaitTermination()
    return aside.read(spark).select("id", "create_time")


def _slice_sql(name: str, key: str) -> str:
    return f"""
      select w, b, count(*) c from (
        select unnest(case when rtrim(text, ' ') = '' and text <> '' then []
                      else string_split(rtrim(text, ' '), ' ') end) w,
               floor(({key} - low) / ceil((high - low + 1) / n)) b
        from {name}, (select min({key}) low, max({key}) high,
                        greatest({SLICES}, ceil(count(*) / {SLICE_ROWS})) n from {name})) group by 1, 2"""


@query(f"""
  select coalesce(d.w, b.w) word, d.c left_cnt, b.c right_cnt
  from ({_slice_sql("documents", "doc_id")}) d full join ({_slice_sql("benchmark", "item_id")}) b
  on d.w = b.w and d.b = b.b""")
def stream_word_joins(spark: SparkSession, folder: str) -> DataFrame:
    """Full join of the word counts of each batch."""
    joins = jobs.word_join_table(new_work_dir(spark, "word-joins"))
    left, right = (_stream(spark, folder, x, each=True).select(F.col("text").alias("value")) for x in ("documents", "benchmark"))
    jobs.run_word_joins(
        left, right, "full", joins, new_work_dir(spark, "checkpoint"), jobs.UNTIL_DRAINED
    ).awaitTermination()
    return joins.read(spark).select("word", "left_cnt", "right_cnt")
