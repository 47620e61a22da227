from __future__ import annotations

import time

import json
import os
import random
from datetime import datetime, timedelta

import pytest

from stream_commerce.operators import intervals, pairing

T0 = datetime(2024, 1, 1)


def random_times(seed, n, keys, span):
    rnd = random.Random(seed)
    return [(i, rnd.choice(keys), rnd.randrange(-span, span)) for i in range(n)]


@pytest.mark.parametrize("width", [1, 10, 500])
def test_interval_pairs_and_unpaired_equal_brute_force(spark, width):
    left = random_times(1, 120, ["hot"] * 6 + ["a", "b"], 300)
    right = random_times(2, 150, ["hot"] * 6 + ["b", "c"], 300)
    ldf = spark.createDataFrame(left, "lid int, k string, lt bigint")
    rdf = spark.createDataFrame(right, "rid int, k string, rt bigint")
    near = {(a[0], b[0]) for a in left for b in right if a[1] == b[1] and abs(a[2] - b[2]) <= width}
    pairs = intervals.interval_pairs(ldf, rdf, ["k"], "lt", "rt", width).collect()
    assert len(pairs) == len(near) and {(p.lid, p.rid) for p in pairs} == near
    alone = {r.lid for r in intervals.without_partner(ldf, rdf, ["k"], "lt", "rt", width).collect()}
    assert alone == {a[0] for a in left} - {p[0] for p in near}


def test_pairing_states_count_every_row(spark):
    orders = [(i, t) for i, _, t in random_times(3, 50, ["x"], 100)]
    lines = [(i % 40, t) for i, _, t in random_times(4, 300, ["x"], 100)] + [(99, 0)] + [(7, 0)] * 200
    states = pairing.pairing_states(
        spark.createDataFrame(orders, "order_id int, order_at bigint"),
        spark.createDataFrame(lines, "order_id int, detail_at bigint"), 20,
    )
    pairs = [(o, d) for o in orders for d in lines if o[0] == d[0] and abs(o[1] - d[1]) <= 20]
    matched_orders, matched_lines = {p[0] for p in pairs}, {p[1] for p in pairs}
    assert {r.state: r.cnt for r in states.collect()} == {
        "matched": len(pairs),
        "info_only": sum(o not in matched_orders for o in orders),
        "early_detail": sum(d not in matched_lines for d in lines),
    }


@pytest.mark.parametrize("salts", [1, 4])
def test_sub_keys_do_not_change_the_pairs(spark, salts):
    orders = [("1", T0), ("2", T0)]
    lines = [("1", f"d{i}", T0 + timedelta(minutes=i - 10)) for i in range(20)] + [("3", "x", T0)]
    odf = spark.createDataFrame(orders, "order_id string, order_ts timestamp")
    ddf = spark.createDataFrame(lines, "order_id string, line string, detail_ts timestamp")
    found = sorted(r.line for r in pairing.pair_orders(odf, ddf, salts=salts).collect())
    assert found == sorted(f"d{i}" for i in range(5, 16))


def test_full_outer_batch_reports_both_sides(spark):
    odf = spark.createDataFrame([("1", T0), ("2", T0)], "order_id string, order_ts timestamp")
    ddf = spark.createDataFrame(
        [("1", "a", T0), ("1", "late", T0 + timedelta(minutes=6)), ("3", "b", T0)],
        "order_id string, line string, detail_ts timestamp",
    )
    rows = pairing.pair_orders(odf, ddf, how="fullOuter").collect()
    assert {(r.order_id, r.order_ts is not None, r.line) for r in rows} == {
        ("1", True, "a"), ("2", True, None), ("1", False, "late"), ("3", False, "b"),
    }
    with pytest.raises(ValueError):
        pairing.pair_orders(odf, ddf, salts=2, how="fullOuter")


def write_part(folder, n, minute, *messages):
    folder.mkdir(exist_ok=True)
    part = folder / f"{n:03d}.txt"
    part.write_text("\n".join(json.dumps(m) for m in messages) + "\n")
    stamp = (T0 + timedelta(minutes=minute) - datetime(1970, 1, 1)).total_seconds()
    os.utime(part, (stamp, stamp))


def order(id, user="u1", province="1"):
    return {"id": id, "user_id": user, "province_id": province, "order_status": "1001",
            "create_time": "2024-01-01 10:00:00", "total_amount": "9.5"}


def line(id, order_id, price="2.5", num="2"):
    return {"id": id, "order_id": order_id, "sku_id": "s", "sku_name": "thing",
            "order_price": price, "sku_num": num}


def test_sales_stream_pairs_early_late_and_resent_messages(spark, tmp_path):
    from pyspark.sql import functions as F

    from stream_commerce.sources.topics import folder_stream
    from stream_commerce.streaming import jobs

    orders, lines = tmp_path / "orders", tmp_path / "lines"
    write_part(orders, 1, 0, order("same"), order("line-late"))
    write_part(lines, 1, 0, line("d1", "same"), line("d2", "same", "x", "y"), line("d3", "line-early"))
    write_part(orders, 2, 3, order("line-early", "nobody"), order("same"), order("lost", "u1", "77"))
    write_part(lines, 2, 3, line("d4", "line-late"), line("d5", "lost"))
    write_part(orders, 3, 20, order("alone"))
    write_part(lines, 3, 20, line("d6", "line-late"), line("d7", "nowhere"))

    users = [("u1", "joe", "gold", "1990-01-01", "M")]
    provinces = [("1", "Hebei", "2", "0310", "CN-13", "CN-HE")]
    table = jobs.sale_table(str(tmp_path / "t"))
    counts = []
    jobs.run_sales(
        folder_stream(spark, str(orders), "o", 1), folder_stream(spark, str(lines), "d", 1),
        lambda s: s.createDataFrame(
            users, "id string, login_name string, user_level string, birthday string, gender string"),
        lambda s: s.createDataFrame(
            provinces,
            "id string, name string, region_id string, area_code string, iso_code string, "
            "iso_3166_2 string"),
        table, str(tmp_path / "c"), as_of=F.lit("2024-01-01"), trigger=jobs.UNTIL_DRAINED,
        on_count=lambda b, n: counts.append(n),
    ).awaitTermination()
    rows = {r.order_detail_id: r for r in jobs.sale_view(spark, table).collect()}
    assert set(rows) == {"d1", "d2", "d3", "d4"} and sum(counts) == 5
    one = rows["d1"]
    assert (one.order_id, one.user_age, one.user_gender, one.user_level) == ("same", 34, "M", "gold")
    assert (one.sku_price, one.sku_num, one.dt, one.province_name) == (2.5, 2, "2024-01-01", "Hebei")
    assert (rows["d2"].sku_price, rows["d2"].sku_num) == (0.0, 0)
    assert (rows["d3"].user_id, rows["d3"].user_age, rows["d3"].user_level) == ("nobody", 0, None)
    lost = jobs.sale_view(spark, table, "unknown_province").collect()
    assert [(r.order_detail_id, r.province_id, r.province_name) for r in lost] == [("d5", "77", None)]


def test_full_outer_stream_reports_unpaired_and_late_rows(spark, tmp_path):
    from stream_commerce.streaming import jobs, sinks

    def source(name, *batches):
        path = str(tmp_path / name)
        for number, rows in enumerate(batches):
            column = "line string" if name == "lines" else "user string"
            df = spark.createDataFrame(rows, f"order_id string, {column}, at timestamp")
            df.coalesce(1).write.mode("append").parquet(path)
        return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)

    far = T0 + timedelta(hours=3)
    orders = source(
        "orders", [("1", "u", T0), ("2", "u", T0)], [("9", "u", far)], [("10", "u", far)],
        [("11", "u", far)],
    )
    # A row counts as late against the watermark of the batch before, hence the batch in between.
    lines = source(
        "lines", [("1", "a", T0), ("3", "b", T0)], [("9", "c", far)], [("10", "d", far)],
        [("2", "late", T0), ("11", "e", far)],
    )
    pairs = pairing.pair_orders(
        orders.withColumnRenamed("at", "order_ts"), lines.withColumnRenamed("at", "detail_ts"),
        how="fullOuter",
    )
    found = []

    def keep(batch, _):
        found.extend((r.order_id, r.user, r.line) for r in batch.collect())

    late = sinks.LateRows()
    spark.streams.addListener(late)
    query = jobs.start(
        pairs.writeStream.foreachBatch(keep), "outer", str(tmp_path / "c"), jobs.UNTIL_DRAINED
    )
    query.awaitTermination()
    assert set(found) == {
        ("1", "u", "a"), ("2", "u", None), ("3", None, "b"), ("9", "u", "c"), ("10", "u", "d"),
        ("11", "u", "e"),
    }
    for _ in range(100):  # reports arrive a little after the batch
        if late.dropped["outer"]:
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert late.dropped["outer"] == 1
