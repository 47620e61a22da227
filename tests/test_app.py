"""All jobs chained over folders: raw logs and row changes in, tables out."""

from __future__ import annotations

import json
import shutil
from datetime import datetime, timezone

import pytest

from stream_commerce import schemas
from stream_commerce.streaming import app, jobs

BASE = 1_704_067_200_000


def put(feeds, topic, *messages):
    folder = feeds / "in" / f"topic={topic}"
    folder.mkdir(parents=True, exist_ok=True)
    name = f"in-{len(list(folder.iterdir())):03d}.txt"
    (folder / name).write_text("".join(json.dumps(m) + "\n" for m in messages))


def page(mid, uid, ts, *actions):
    return {"common": {"mid": mid, "uid": uid}, "page": {"page_id": "trade"}, "ts": ts,
            "actions": [{"action_id": a, "item": i, "ts": ts} for a, i in actions]}


def change(table, op, seq, **columns):
    return {"table": table, "kind": "ROWDATA", "op": op, "seq": seq, "ts": BASE,
            "rows": [[{"name": k, "value": v} for k, v in columns.items()]]}


def test_chain(spark, tmp_path):
    feeds, store = tmp_path / "feeds", tmp_path / "store"
    put(
        feeds, schemas.BASE_LOG_TOPIC,
        {"common": {"mid": "m1", "uid": "1"}, "start": {"entry": "icon"}, "ts": BASE + 5},
        {"common": {"mid": "m1", "uid": "1"}, "start": {"entry": "push"}, "ts": BASE},
        {"common": {"mid": "m2", "uid": "1"}, "start": {"entry": "icon"}, "err": {}, "ts": BASE},
        page("m1", "1", BASE + 10, ("favor_add", "sku9"), ("trade_add_address", None)),
        page("m1", "2", BASE + 20, ("trade_add_address", None)),
        page("m1", "3", BASE + 30, ("cart_add", "sku1")),
        page("z", "z", BASE + 7_200_000, ("trade_add_address", None)),
        {"common": {"mid": "m5"}, "start": {"entry": "x"}, "ts": "soon"},
        {"common": {"mid": "m6"}, "page": {}, "actions": [{"action_id": "cart_add"}], "ts": 1},
        "no object",
    )
    put(
        feeds, app.CHANGE_TOPIC,
        change("user_info", "INSERT", 1, id="7", user_level="1", birthday="1990-01-01", gender="F"),
        change("user_info", "UPDATE", 2, id="7", user_level="2", birthday="1990-01-01", gender="F"),
        change("order_info", "INSERT", 3, id="o1", user_id="7", province_id="1", order_status="1001",
               create_time="2024-01-01 10:00:00", total_amount="12.50"),
        change("order_info", "UPDATE", 4, id="o1", total_amount="99"),
        change("order_info", "INSERT", 6, id="o2", user_id="7", province_id="1", create_time="2024-01-01 11:00:00",
               total_amount="n/a"),
        change("order_detail", "INSERT", 7, id="d2", order_id="o2", sku_id="s", order_price="1", sku_num="1"),
        change("order_detail", "INSERT", 5, id="d1", order_id="o1", sku_id="s", sku_name="thing",
               order_price="12.50", sku_num="1"),
    )
    provinces = str(tmp_path / "provinces")
    spark.createDataFrame(
        [("1", "Hebei", "2", "0310", "CN-13", "CN-HE")],
        ", ".join(f"{c} string" for c in schemas.PROVINCE_INFO.fieldNames()),
    ).write.parquet(provinces)

    def run(job, *more):
        args = app.parse_args([
            job, "--store", str(store), "--feeds", str(feeds), "--drain", "--provinces", provinces,
            "--now-ms", str(BASE + 1000), *more,
        ])
        app.start(spark, args).awaitTermination()

    for job in ("diversion", "badlogs", "changes", "users", "starts", "openstarts", "outsidestarts", "gmv", "actions", "alerts", "sales"):
        run(job)

    def aside(name, make=jobs.unreadable_table):
        return make(f"{store}/unreadable/{name}").read(spark).collect()

    # Rows in = rows out + rows kept aside + rows routed away.
    assert [r.value for r in aside("logs")] == ['"no object"']
    assert ["soon" in r.value or json.loads(r.value)["mid"] == "m5" for r in aside("starts")] == [True]
    assert [json.loads(r.value)["mid"] for r in aside("actions")] == ["m6"]
    assert [r.id for r in aside("orders", jobs.unreadable_order_table)] == ["o2"]

    starts = jobs.first_start_view(spark, jobs.start_table(f"{store}/starts")).collect()
    assert [(r.mid, r.entry, r.ts) for r in starts] == [("m1", "push", BASE)]
    opened = jobs.first_start_view(spark, jobs.first_start_table(f"{store}/openstarts")).collect()
    assert [(r.mid, r.entry, r.ts) for r in opened] == [("m1", "push", BASE)]
    assert jobs.outside_start_table(f"{store}/outsidestarts").read(spark).count() == 0
    totals = jobs.gmv_view(spark, jobs.gmv_table(f"{store}/gmv")).collect()
    assert [(r.create_date, r.create_hour, float(r.gmv)) for r in totals] == [("2024-01-01", "10", 12.5)]
    found = jobs.alert_view(spark, jobs.alert_table(f"{store}/alerts")).collect()
    wanted = {
        ("user", "1", None, None), ("user", "2", None, None), ("item", None, "sku9", None),
        ("event", "1", "sku9", "favor_add"), ("event", "1", None, "trade_add_address"),
        ("event", "2", None, "trade_add_address"),
    }
    for alert in {r.id for r in found}:
        assert {(r.kind, r.uid, r.item, r.action_id) for r in found if r.id == alert} == wanted
    assert {r.mid for r in found} == {"m1"}
    assert {r.date for r in found} == {
        datetime.fromtimestamp(BASE / 1000, timezone.utc).strftime("%Y-%m-%d")
    }
    sale, other = sorted(jobs.sale_view(spark, jobs.sale_table(f"{store}/sales")).collect())
    # An amount that cannot be read loses no sale.
    assert (other.order_detail_id, other.user_level) == ("d2", "2")
    assert (sale.order_detail_id, sale.user_level, sale.user_gender, sale.province_name) == (
        "d1", "2", "F", "Hebei")

    # The feeder repeats its batch, as a topic writer may after a failure, and sales start over.
    replayed = feeds / "changes2"
    shutil.copytree(feeds / "changes", replayed)
    run("gmv")
    run("sales", "--run", "v2")
    totals = jobs.gmv_view(spark, jobs.gmv_table(f"{store}/gmv")).collect()
    assert [float(r.gmv) for r in totals] == [12.5]
    again = jobs.sale_view(spark, jobs.sale_table(f"{store}/sales", "v2")).collect()
    assert {(r.order_detail_id, r.user_level, r.user_gender) for r in again} == {("d1", "2", "F"), ("d2", "2", "F")}


def test_a_source_is_required():
    with pytest.raises(SystemExit):
        app.parse_args(["gmv", "--store", "x"])
