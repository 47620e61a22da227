"""Every registered query against its SQL, and the shape of the important plans."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

import __spark_entry__ as contract
from stream_commerce.plans import catalog
from stream_commerce.streaming.batch_table import BatchTable
from tests.compare import difference


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_same_rows_as_sql(spark, folder, con, name):
    assert name in catalog.ORACLES
    assert difference(catalog.QUERIES[name](spark, folder), con, catalog.ORACLES[name]) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["create_date", "create_hour", "gmv"]


def plan_of(df, mode="formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


BATCH = [n for n in catalog.QUERIES if not n.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_plan_has_no_product_join_and_no_python(spark, folder, name):
    plan = plan_of(catalog.QUERIES[name](spark, folder))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in plan


@pytest.mark.parametrize("name, parses", [("log_topic_rows", 1), ("log_starts", 2), ("gmv_from_messages", 1)])
def test_each_text_is_parsed_once(spark, folder, name, parses):
    plan = plan_of(catalog.QUERIES[name](spark, folder), "simple")
    assert plan.count("from_json(") == parses


def test_scan_reads_only_what_is_needed(spark, folder):
    plan = plan_of(catalog.gmv_by_date_hour(spark, folder))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
    assert "EqualTo(event_type,purchase)" in plan


def test_diversion_does_not_shuffle(spark, folder):
    assert "Exchange" not in plan_of(catalog.log_topic_rows(spark, folder))


def test_totals_shuffle_once(spark, folder):
    plan = plan_of(catalog.gmv_by_date_hour(spark, folder), "simple")
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_alert_rows_share_their_shuffles(spark, folder):
    df = catalog.alert_window(spark, folder)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    hashed = final.count("Exchange hashpartitioning") - final.count("ReusedExchange")
    assert final.count("Exchange hashpartitioning") and hashed <= 5, final


@pytest.mark.parametrize("name, fields", [
    ("gmv_from_messages", "total_amount:string,create_time:string"), ("log_route_counts", "StructField(common,StructType()"),
])
def test_only_the_needed_fields_are_parsed(spark, folder, name, fields):
    plan = plan_of(catalog.QUERIES[name](spark, folder), "simple")
    parsed = re.search(r"from_json\((.*)", plan)[1]
    assert all(x.split(":")[0] in parsed for x in fields.split(",")) and "province_id" not in parsed


STREAMS = [n for n in catalog.QUERIES if n.startswith("stream_")]


def test_streams_run_over_several_batches(spark, folder, monkeypatch):
    seen = {}
    real = BatchTable.write

    def write(self, df, batch_id):
        seen.setdefault(self.root, set()).add(batch_id)
        real(self, df, batch_id)

    monkeypatch.setattr(BatchTable, "write", write)
    for name in ("stream_first_starts", "stream_gmv", "stream_user_state", "stream_wordcount", "stream_word_joins"):
        catalog.QUERIES[name](spark, folder).count()
    assert seen and all(len(ids) >= 3 for ids in seen.values())
