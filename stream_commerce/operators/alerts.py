"""Coupon-abuse alerts: several users adding a delivery address on one device within a window.

Windows are `window_ms` long and end every `slide_ms`, so each action lies in
`window_ms / slide_ms` of them; a pane is one `slide_ms` step. Alerts are decided from the trigger
actions alone. All other actions are touched once, by a join on (device, user, stretch of panes)
with the triggers near them, and only those of suspects are then spread over windows.

Expected columns: mid, uid, action_id, item, ts (epoch milliseconds). A missing uid counts as a
user and a missing mid as a device.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stream_commerce.functions.records import CORRUPT, joined_key, parse_json
from stream_commerce.functions.times import SHANGHAI, date_of, floor_div, local_time, minute_of
from stream_commerce.operators.joins import null_safe_join
from stream_commerce.operators.latest import last_per_key
from stream_commerce.schemas import ACTION_LOG


@dataclass(frozen=True)
class AlertRule:
    trigger: str = "trade_add_address"
    item_action: str = "favor_add"
    min_users: int = 2
    window_ms: int = 5 * 60 * 1000
    slide_ms: int = 30 * 1000

    @property
    def panes(self) -> int:
        if self.window_ms % self.slide_ms:
            raise ValueError("window_ms must be a multiple of slide_ms")
        return self.window_ms // self.slide_ms


DEFAULT_RULE = AlertRule()
_ALERT = ["mid", "window_end"]
_RECORD = T.StructType([ACTION_LOG[c] for c in ("mid", "uid", "action_id", "item", "ts")])
_EVENT = [*_ALERT, "users", "uid", "ts", "action_id", "item"]
USER, ITEM, EVENT = "user", "item", "event"


def parse_actions(values: DataFrame, value: str = "value") -> DataFrame:
    """(mid, uid, action_id, item, ts) of the actions with a numeric ts; only these five fields are
    parsed. Rows without a ts lie in no window: see `unreadable_actions`."""
    parsed = parse_json(values, _RECORD, value).drop(CORRUPT)
    return parsed.withColumn("ts", F.col("ts").try_cast("bigint")).filter(
        F.col("ts").isNotNull()
    )


def unreadable_actions(values: DataFrame, value: str = "value") -> DataFrame:
    """The texts (value) that `parse_actions` leaves out."""
    kept = values.select(F.col(value).alias("value"), F.col(value).alias("_text"))
    parsed = parse_json(kept, _RECORD, "_text")
    return parsed.filter(F.col("ts").try_cast("bigint").isNull()).select("value")


def _pane(rule: AlertRule) -> Column:
    return floor_div(F.col("ts"), rule.slide_ms)


def _trigger_panes(actions: DataFrame, rule: AlertRule) -> DataFrame:
    """(mid, uid, pane): panes with a trigger action, once each. Copies are dropped before they are
    shuffled, and by pane, so a user with many triggers is dealt over tasks."""
    triggers = actions.filter(F.col("action_id") == rule.trigger)
    return triggers.select("mid", "uid", _pane(rule).alias("pane")).distinct()


def suspects(actions: DataFrame, rule: AlertRule = DEFAULT_RULE) -> DataFrame:
    """(mid, uid, window_end): users with a trigger action in the window, once each.

    A trigger pane opens only the windows that the user's previous one did not, so the spread rows
    are distinct. A user has at most one row per pane here, however many
    actions were sent.
    """
    previous = F.lag("pane").over(Window.partitionBy("mid", "uid").orderBy("pane"))
    last = F.col("pane") + F.lit(rule.panes)
    opened = _trigger_panes(actions, rule).withColumn("before", previous + F.lit(rule.panes))
    first = F.greatest(F.col("pane"), F.col("before")) + 1
    spread = opened.select("mid", "uid", F.explode(F.sequence(first, last)).alias("end"))
    return spread.select("mid", "uid", (F.col("end") * F.lit(rule.slide_ms)).alias("window_end"))


def alert_windows(
    actions: DataFrame, rule: AlertRule = DEFAULT_RULE, users: DataFrame | None = None
) -> DataFrame:
    """(mid, window_end, users): devices with at least `min_users` suspects in the window."""
    users = suspects(actions, rule) if users is None else users
    counted = users.groupBy(*_ALERT).agg(F.count(F.lit(1)).alias("users"))
    return counted.filter(F.col("users") >= rule.min_users)


def alert_id(zone: str = SHANGHAI) -> Column:
    """`minute_mid`: alerts of one device in one minute share an id and replace each other."""
    return joined_key(minute_of(local_time("window_end", zone)), F.col("mid"))


def latest_per_minute(windows: DataFrame, zone: str = SHANGHAI) -> DataFrame:
    """The last alert of each device and minute."""
    keyed = windows.withColumn("id", alert_id(zone))
    return last_per_key(keyed, ["id", "mid"], ["window_end"])


def _suspect_actions(actions: DataFrame, rule: AlertRule) -> DataFrame:
    """Actions with `ends`, the windows in which their user is a suspect; others are left out.

    Such a window holds the action and a trigger, so only the last trigger up to the action's pane
    and the first one after it matter. Triggers are looked up in stretches as long as a window,
    each holding the panes of its neighbours too: never more than three times `rule.panes`.
    """
    stretch = floor_div(F.col("pane"), rule.panes)
    near = (
        _trigger_panes(actions, rule)
        .select(
            "mid", "uid", "pane",
            F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("stretch"),
        )
        .groupBy("mid", "uid", "stretch").agg(F.collect_set("pane").alias("panes"))
    )
    placed = actions.select("mid", "uid", "action_id", "item", "ts", _pane(rule).alias("pane"))
    found = null_safe_join(
        placed.withColumn("stretch", stretch), near, ["mid", "uid", "stretch"]
    )
    pane = F.col("pane")
    before = F.array_max(F.filter("panes", lambda p: p <= pane))
    after = F.array_min(F.filter("panes", lambda p: p > pane))
    ends = F.filter(
        F.sequence(pane + 1, pane + F.lit(rule.panes)),
        lambda end: (end <= before + F.lit(rule.panes)) | (end > after),
    )
    return found.select("mid", "uid", "action_id", "item", "ts", ends.alias("ends")).filter(
        F.size("ends") > 0
    )


def _spread(rows: DataFrame, rule: AlertRule) -> DataFrame:
    """One row per entry of `ends`, as `window_end`."""
    others = [c for c in rows.columns if c != "ends"]
    spread = rows.select(*others, F.explode("ends").alias("end"))
    return spread.select(*others, (F.col("end") * F.lit(rule.slide_ms)).alias("window_end"))


def alert_events(
    actions: DataFrame, windows: DataFrame, rule: AlertRule = DEFAULT_RULE
) -> DataFrame:
    """One row per alert and action of its suspects: the payload before it is nested."""
    spread = _spread(_suspect_actions(actions, rule), rule)
    return null_safe_join(spread, windows.select(*_ALERT, "users"), _ALERT).select(*_EVENT)


def alert_rows(
    actions: DataFrame,
    windows: DataFrame | None = None,
    rule: AlertRule = DEFAULT_RULE,
    zone: str = SHANGHAI,
) -> DataFrame:
    """Alerts as rows: id, mid, window_end, users, kind, uid, item, action_id, ts, date.

    kind `event` is an action of a suspect (uid, item, action_id, ts), kind `user` a suspect (uid) and
    kind `item` an item named by an `item_action`, once each. The rows of one id are the alert; it
    has this form at any size, so a device with a third of all traffic fills rows, not a row.
    """
    if windows is None:
        windows = alert_windows(actions, rule)
    events = alert_events(actions, windows, rule)
    whole = [*_ALERT, "users"]
    suspected = events.filter(F.col("action_id") == rule.trigger).select(*whole, "uid").distinct()
    named = events.filter(F.col("action_id") == rule.item_action).select(*whole, "item").distinct()
    rows = (
        events.withColumn("kind", F.lit(EVENT))
        .unionByName(suspected.withColumn("kind", F.lit(USER)), allowMissingColumns=True)
        .unionByName(named.withColumn("kind", F.lit(ITEM)), allowMissingColumns=True)
    )
    return rows.select(
        alert_id(zone).alias("id"), *whole, "kind", "uid", "item", "action_id", "ts",
        date_of(local_time("window_end", zone)).alias("date"),
    )
