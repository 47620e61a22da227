from __future__ import annotations

import json
from decimal import Decimal

from stream_commerce.operators import gmv
from stream_commerce.sources.topics import folder_stream
from stream_commerce.streaming import jobs


def order(id, amount, at="2022-04-27 03:18:39"):
    return json.dumps({"id": str(id), "total_amount": amount, "create_time": at})


def totals(df):
    return {(r.create_date, r.create_hour): r.gmv for r in df.collect()}


def test_quoted_and_plain_amounts(spark):
    df = spark.createDataFrame([(order(1, "0.10"),), (order(2, 0.20),)], "value string")
    parsed = gmv.parse_orders(df)
    assert totals(gmv.partial_totals(gmv.readable(parsed))) == {("2022-04-27", "03"): Decimal("0.30")}


def test_unreadable_rows_are_kept_apart(spark):
    rows = [order(1, "5"), order(2, "x"), order(3, "5", "27.04.2022"), order(4, None), "{"]
    parsed = gmv.parse_orders(spark.createDataFrame([(r,) for r in rows], "value string"))
    assert [r.id for r in gmv.readable(parsed).collect()] == ["1"]
    bad = gmv.unreadable(parsed).collect()
    assert [r.id for r in bad] == ["2", "3", "4", None]
    assert [r._corrupt for r in bad] == [None, None, None, "{"]


def run(spark, path, table, checkpoint):
    stream = folder_stream(spark, path, "orders", max_files_per_batch=1)
    jobs.run_gmv(stream, table, checkpoint, jobs.UNTIL_DRAINED).awaitTermination()


def test_stream_total_survives_restart_and_replay(spark, feed, tmp_path):
    path = feed(order(1, "1.50"), order(2, "2.25"))
    feed(order(3, "4"), order(4, "8", "2022-04-27 04:00:00"))
    feed(order(5, "16"), order(6, "bad"))
    table, checkpoint = jobs.gmv_table(str(tmp_path / "t")), tmp_path / "c"
    run(spark, path, table, str(checkpoint))
    expected = {("2022-04-27", "03"): Decimal("23.75"), ("2022-04-27", "04"): Decimal("8.00")}
    assert totals(jobs.gmv_view(spark, table)) == expected

    (checkpoint / "commits" / "2").unlink()
    for crc in (checkpoint / "commits").glob(".2.crc"):
        crc.unlink()
    run(spark, path, table, str(checkpoint))
    assert totals(jobs.gmv_view(spark, table)) == expected

    feed(order(7, "0.25"))
    run(spark, path, table, str(checkpoint))
    expected[("2022-04-27", "03")] = Decimal("24.00")
    assert totals(jobs.gmv_view(spark, table)) == expected


def test_order_sent_twice_counts_once_when_asked(spark, feed, tmp_path):
    path = feed(order(1, "1"), order(1, "1"))
    feed(order(1, "1"), order(2, "2"))
    table = jobs.gmv_table(str(tmp_path / "t"))
    stream = folder_stream(spark, path, "orders", max_files_per_batch=1)
    jobs.run_gmv(
        stream, table, str(tmp_path / "c"), jobs.UNTIL_DRAINED, once_within="2 hours"
    ).awaitTermination()
    assert totals(jobs.gmv_view(spark, table)) == {("2022-04-27", "03"): Decimal("3.00")}
