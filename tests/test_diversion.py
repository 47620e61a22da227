from __future__ import annotations

import json

import pytest

from stream_commerce.operators import diversion
from stream_commerce.schemas import ACTION_TOPIC, START_TOPIC

DEDUP_POLICY = "spark.sql.mapKeyDedupPolicy"

COMMON = {"mid": "m1", "uid": "u1", "os": "x"}


@pytest.fixture(params=["LAST_WIN", "EXCEPTION"])
def session(spark, request):
    before = spark.conf.get(DEDUP_POLICY)
    spark.conf.set(DEDUP_POLICY, request.param)
    yield spark
    spark.conf.set(DEDUP_POLICY, before)


def divert(spark, *logs):
    texts = [log if isinstance(log, str) else json.dumps(log) for log in logs]
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = diversion.divert(raw).collect()
    return [(r.topic, json.loads(r.value)) for r in rows]


def test_start_record_merges_common_ts_and_start(session):
    log = {"common": COMMON, "start": {"entry": "icon", "loading_time": 18776, "os": "y"}, "ts": 5}
    assert divert(session, log) == [
        (START_TOPIC, {"mid": "m1", "uid": "u1", "os": "y", "ts": 5, "entry": "icon",
                       "loading_time": 18776}),
    ]


def test_quoted_ts_becomes_a_number_and_start_may_replace_it(session):
    first = {"common": COMMON, "start": {"a": 1}, "ts": "5"}
    second = {"common": COMMON, "start": {"ts": 7}, "ts": 5}
    values = [v["ts"] for _, v in divert(session, first, second)]
    assert values == [5, 7]


def test_each_action_is_merged_on_its_own(session):
    log = {"common": COMMON, "page": {"page_id": "p", "os": "z"},
           "actions": [{"action_id": "a", "item": "1"}, {"action_id": "b", "os": "w"}], "ts": 5}
    assert divert(session, log) == [
        (ACTION_TOPIC, {"mid": "m1", "uid": "u1", "os": "z", "page_id": "p", "action_id": "a",
                        "item": "1"}),
        (ACTION_TOPIC, {"mid": "m1", "uid": "u1", "os": "w", "page_id": "p", "action_id": "b"}),
    ]


def test_numbers_and_nested_objects_keep_their_type(session):
    log = {"common": {"mid": "m", "n": 1, "d": 1.5, "b": True, "o": {"x": [1, "2"]}},
           "start": {"s": "1"}, "ts": 5}
    assert divert(session, log) == [
        (START_TOPIC, {"mid": "m", "n": 1, "d": 1.5, "b": True, "o": {"x": [1, "2"]}, "ts": 5,
                       "s": "1"}),
    ]


def test_null_values_are_left_out_and_null_replaces(session):
    log = {"common": {"mid": "m", "os": "x", "ch": None}, "start": {"os": None, "t": "a:null"}}
    assert divert(session, log) == [(START_TOPIC, {"mid": "m", "t": "a:null"})]


def test_start_wins_over_actions_and_err_drops(session):
    actions = {"page": {"page_id": "p"}, "actions": [{"action_id": "a"}]}
    assert [t for t, _ in divert(session, {"common": COMMON, "start": {"e": 1}, **actions})] == [
        START_TOPIC]
    assert divert(session, {"common": COMMON, "start": {"e": 1}, "err": {"code": 1}, **actions}) == []
    assert divert(session, {"common": COMMON, "start": {"e": 1}, "err": None}) == []


@pytest.mark.parametrize("log", [
    {"common": COMMON, "page": {"page_id": "p"}, "actions": []},
    {"common": COMMON, "page": {"page_id": "p"}},
    {"start": {"entry": "icon"}, "ts": 1},
    "not json",
    "",
])
def test_logs_that_yield_nothing(session, log):
    assert divert(session, log) == []


def test_only_one_route(spark):
    logs = [{"common": COMMON, "start": {"e": 1}, "ts": 1},
            {"common": COMMON, "page": {"p": 1}, "actions": [{"a": 1}, {"a": 2}]}]
    raw = spark.createDataFrame([(json.dumps(log),) for log in logs], "value string")
    assert diversion.divert(raw, only=diversion.START).count() == 1
    assert diversion.divert(raw, only=diversion.ACTION).count() == 2
    counts = {r.route: r.logs for r in diversion.route_counts(raw).collect()}
    assert counts == {"start": 1, "action": 1}


def test_repeated_key_keeps_the_last_value(session):
    log = '{"common":{"mid":"a","mid":"b"},"start":{"e":1},"ts":2}'
    assert divert(session, log) == [(START_TOPIC, {"mid": "b", "ts": 2, "e": 1})]


def test_unreadable_logs_are_told_apart(spark):
    texts = ["{", '{"common":{"mid":"a"},"start":{},"ts":1}', '{"common":{"mid":"a"},"err":null}', "[1"]
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    assert {r.value for r in diversion.unreadable_logs(raw).collect()} == {"{", "[1"}
