from __future__ import annotations

import json
import random
from collections import defaultdict

import pytest

from stream_commerce.operators import alerts
from stream_commerce.sources.topics import folder_stream
from stream_commerce.streaming import jobs

RULE = alerts.AlertRule()
SCHEMA = "mid string, uid string, action_id string, item string, ts bigint"
BASE = 1_704_067_200_000
KINDS = ["trade_add_address", "favor_add", "cart_add", "favor_cancel"]


def brute_force(rows, rule=RULE):
    """(mid, window_end) -> users, uids, items and events, window by window."""
    found = {}
    times = [r[4] for r in rows]
    end = (min(times) // rule.slide_ms + 1) * rule.slide_ms
    while end <= max(times) + rule.window_ms:
        groups = defaultdict(list)
        for row in rows:
            if end - rule.window_ms <= row[4] < end:
                groups[row[0], row[1]].append(row)
        devices = defaultdict(list)
        for (mid, _), logs in groups.items():
            if any(r[2] == rule.trigger for r in logs):
                devices[mid].append(logs)
        for mid, users in devices.items():
            if len(users) >= rule.min_users:
                logs = [r for user in users for r in user]
                found[mid, end] = (
                    len(users), {r[1] for r in logs},
                    {r[3] for r in logs if r[2] == rule.item_action}, sorted(r[2] for r in logs),
                )
        end += rule.slide_ms
    return found


def random_actions(seed, n=400, span_ms=20 * 60_000):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        rows.append((
            rnd.choice(["a", "b", "hot", "hot", None]), rnd.choice(["1", "2", "3", None]),
            rnd.choices(KINDS, [1, 3, 4, 4])[0], rnd.choice(["i1", "i2", None]),
            BASE + rnd.randrange(span_ms),
        ))
    return rows


def gathered(rows):
    """The rows of each alert put together."""
    found = {}
    for r in rows:
        users, uids, items, events = found.setdefault((r.mid, r.window_end), (r.users, [], [], []))
        {"user": uids, "item": items, "event": events}[r.kind].append(
            {"user": r.uid, "item": r.item, "event": r.action_id}[r.kind])
    for _, uids, items, _ in found.values():
        assert len(uids) == len(set(uids)) and len(items) == len(set(items))
    return {k: (u, set(a), set(b), sorted(e)) for k, (u, a, b, e) in found.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_equal_brute_force_with_missing_users_and_devices(spark, seed):
    rows = random_actions(seed) + [("hot", "1", "favor_add", "i9", BASE + 1000)] * 50
    found = alerts.alert_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = brute_force(rows)
    assert expected and gathered(found) == expected


def test_rows_carry_times_and_ids_that_name_minute_and_device(spark):
    rows = [
        ("m", "1", "cart_add", None, BASE + 3), ("m", "1", "trade_add_address", None, BASE + 2),
        ("m", "2", "trade_add_address", None, BASE + 4), ("m", "3", "cart_add", "x", BASE + 1),
        ("m", "2", "favor_add", "i", BASE + 5),
    ]
    found = [r for r in alerts.alert_rows(spark.createDataFrame(rows, SCHEMA)).collect() if r.window_end == BASE + 30_000]
    events = sorted((r.ts, r.uid, r.action_id, r.item) for r in found if r.kind == "event")
    assert events == [(BASE + 2, "1", "trade_add_address", None), (BASE + 3, "1", "cart_add", None),
                      (BASE + 4, "2", "trade_add_address", None), (BASE + 5, "2", "favor_add", "i")]
    assert sorted(r.uid for r in found if r.kind == "user") == ["1", "2"]
    assert [r.item for r in found if r.kind == "item"] == ["i"]
    assert {(r.id, r.date, r.users) for r in found} == {("2024-01-01T08:00_m", "2024-01-01", 2)}


def test_unreadable_actions_are_told_apart(spark):
    texts = ['{"mid":"m","ts":"soon"}', "{", '{"mid":"m","ts":5}']
    values = spark.createDataFrame([(t,) for t in texts], "value string")
    assert {r.value for r in alerts.unreadable_actions(values).collect()} == set(texts[:2])
    assert alerts.parse_actions(values).count() == 1


def test_latest_per_minute(spark):
    windows = spark.createDataFrame(
        [("m", BASE, 2), ("m", BASE + 30_000, 3), ("m", BASE + 60_000, 2), ("n", BASE, 5)],
        "mid string, window_end bigint, users bigint",
    )
    rows = {(r.mid, r.window_end, r.users) for r in alerts.latest_per_minute(windows).collect()}
    assert rows == {("m", BASE + 30_000, 3), ("m", BASE + 60_000, 2), ("n", BASE, 5)}


def test_window_must_be_a_multiple_of_the_slide():
    with pytest.raises(ValueError):
        alerts.AlertRule(window_ms=100, slide_ms=30).panes


def test_stream_gives_the_batch_alerts(spark, feed, tmp_path):
    rows = sorted(random_actions(4), key=lambda r: r[4])
    names = ["mid", "uid", "action_id", "item", "ts"]
    texts = [json.dumps({k: v for k, v in zip(names, r) if v is not None}) for r in rows]
    third = len(texts) // 3
    path = feed(*texts[:third])
    feed(*texts[third:2 * third])
    feed(*texts[2 * third:])
    # A later action of no interest moves the watermark past the last window.
    sentinel = {"mid": "z", "uid": "z", "action_id": RULE.trigger, "ts": rows[-1][4] + 3_600_000}
    feed(json.dumps(sentinel))

    # The actions are kept by their own time, so it does not matter that all of them arrive now.
    kept_actions = jobs.action_table(str(tmp_path / "a"))
    jobs.run_action_log(
        folder_stream(spark, path, "actions"), kept_actions, str(tmp_path / "ca"), jobs.UNTIL_DRAINED
    ).awaitTermination()

    def action_log(session, from_ms, to_ms):
        found = jobs.actions_between(session, kept_actions, from_ms, to_ms)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(date" in plan
        return found

    table, counts = jobs.alert_table(str(tmp_path / "t")), []
    stream = folder_stream(spark, path, "actions", max_files_per_batch=1)
    jobs.run_alerts(
        stream, action_log, table, str(tmp_path / "c"), trigger=jobs.UNTIL_DRAINED,
        on_count=lambda batch, n: counts.append((batch, n)),
    ).awaitTermination()
    # Batches without a closed alert window report 0 and the query goes on.
    assert len(counts) >= 3 and counts[0] == (0, 0) and sum(n for _, n in counts) > 0
    expected = brute_force(rows)
    last = {}
    for mid, end in expected:
        key = (mid, end // 60_000)
        last[key] = max(last.get(key, 0), end)
    kept = {k: v for k, v in expected.items() if last[k[0], k[1] // 60_000] == k[1]}
    assert kept and gathered(jobs.alert_view(spark, table).collect()) == kept
