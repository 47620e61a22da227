"""Results that streams show before, beside and after their main rows: open windows, unpaired and late rows,
stored positions, totals held as state."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from stream_commerce.operators import alerts, gmv
from stream_commerce.operators.alerts import DEFAULT_RULE as RULE
from stream_commerce.plans import catalog
from stream_commerce.sources.topics import folder_stream
from stream_commerce.streaming import jobs

T0 = datetime(2024, 1, 1, 10)
BASE = 1_704_103_200_000


def forget_batch(checkpoint, batch):
    """Make a restart replay the batch."""
    (checkpoint / "commits" / str(batch)).unlink()
    for crc in (checkpoint / "commits").glob(f".{batch}.crc"):
        crc.unlink()


def action(mid, uid, ts, kind=RULE.trigger):
    return json.dumps({"mid": mid, "uid": uid, "action_id": kind, "ts": ts})


def test_alerts_are_known_while_their_window_is_open(spark, feed, tmp_path):
    path = feed(action("m", "a", BASE), action("n", "a", BASE), action("m", "c", BASE, "click"))
    feed(action("m", "b", BASE + 40_000), action("m", "b", BASE + 41_000))
    table, checkpoint = jobs.suspect_table(str(tmp_path / "t")), tmp_path / "c"
    stream = folder_stream(spark, path, "actions", max_files_per_batch=1)

    def run():
        jobs.run_early_alerts(stream, table, str(checkpoint), trigger=jobs.UNTIL_DRAINED).awaitTermination()
        return {tuple(r) for r in jobs.early_alert_view(spark, table).collect()}

    found = run()
    # No later action has come: every window that holds both users is still open for the watermark.
    assert found == {("m", BASE + end * 1000, 2) for end in range(60, 301, 30)}
    assert jobs.early_alert_view(spark, table, before=1).count() == 0
    feed(action("m", "d", BASE + 50_000))
    found = run()
    assert {u for m, e, u in found if BASE + 60_000 <= e <= BASE + 300_000} == {3}
    typed = alerts.parse_actions(spark.read.text(path))
    assert found == {tuple(r) for r in alerts.alert_windows(typed).select("mid", "window_end", "users").collect()}


def write(folder, n, rows, spark, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_every_row_is_paired_unpaired_or_late(spark, tmp_path):
    rng = random.Random(4)
    headers = [(str(k), T0 + timedelta(seconds=rng.randrange(1800)), f"h{k}") for k in range(60)]
    lines = [(str(rng.randrange(80)), T0 + timedelta(seconds=rng.randrange(1800)), f"l{k}") for k in range(150)]
    far = T0 + timedelta(hours=3)
    late = [("5", T0, "late1"), ("999", T0, "late2")]
    one, two = "order_id string, order_ts timestamp, name string", "order_id string, detail_ts timestamp, item string"
    folders = str(tmp_path / "h"), str(tmp_path / "l")
    for folder, rows, schema in ((folders[0], headers, one), (folders[1], lines, two)):
        ordered = sorted(rows, key=lambda r: r[1])
        for n in range(3):
            write(folder, n, ordered[n * len(rows) // 3:(n + 1) * len(rows) // 3], spark, schema)
        write(folder, 3, [("z", far, "end")], spark, schema)
    write(folders[0], 4, [("y", far, "end")], spark, one)
    write(folders[1], 4, late + [("y", far, "end")], spark, two)

    def read(folder, schema):
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)

    lost = jobs.unpaired_table(str(tmp_path / "u"))
    jobs.run_unpaired(read(folders[0], one), read(folders[1], two), lost, str(tmp_path / "c"), jobs.UNTIL_DRAINED).awaitTermination()
    behind = jobs.BatchTable(str(tmp_path / "late"), two)
    jobs.run_late_rows(read(folders[1], two), "detail_ts", behind, jobs.mark_table(str(tmp_path / "m")), str(tmp_path / "c2"),
                       jobs.UNTIL_DRAINED).awaitTermination()
    near = lambda a, b: abs(a - b) <= timedelta(minutes=5)
    alone_h = {h[2] for h in headers if not any(x[0] == h[0] and near(x[1], h[1]) for x in lines)}
    alone_l = {x[2] for x in lines if not any(x[0] == h[0] and near(x[1], h[1]) for h in headers)}
    rows = [(r["kind"], json.loads(r["row"])) for r in lost.read(spark).collect()]
    assert {r["name"] for k, r in rows if k == jobs.INFO_ONLY} == alone_h
    assert {r["item"] for k, r in rows if k == jobs.EARLY_DETAIL} == alone_l
    assert len(rows) == len(alone_h) + len(alone_l) and alone_h and alone_l
    assert {r["item"] for r in behind.read(spark).collect()} == {"late1", "late2"}
    paired = {x[2] for x in lines if any(x[0] == h[0] and near(x[1], h[1]) for h in headers)}
    assert len(paired) + len(alone_l) + 2 == len(lines) + len(late)


def test_late_rows_are_the_same_after_a_replay(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "id int, at timestamp"
    batches = [[(1, T0), (2, None)], [(3, T0 + timedelta(hours=1)), (4, T0 - timedelta(minutes=4))],
               [(5, T0 + timedelta(minutes=54)), (6, T0 + timedelta(minutes=56)), (7, None)]]
    for n, rows in enumerate(batches):
        write(folder, n, rows, spark, schema)
    table, marks, checkpoint = jobs.BatchTable(str(tmp_path / "t"), schema), jobs.mark_table(str(tmp_path / "m")), tmp_path / "c"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    for _ in range(2):
        jobs.run_late_rows(stream, "at", table, marks, str(checkpoint), jobs.UNTIL_DRAINED).awaitTermination()
        assert [r["id"] for r in table.read(spark).collect()] == [5]
        forget_batch(checkpoint, 2)


def order(id, amount, time="2022-04-27 03:18:39"):
    return json.dumps({"id": str(id), "create_time": time, "total_amount": str(amount)})


def test_totals_held_as_state_survive_a_restart(spark, feed, tmp_path):
    path = feed(order(1, "1.50"), order(2, "bad"))
    feed(order(3, "4"), order(4, "8", "2022-04-27 04:00:00"))
    checkpoint = str(tmp_path / "c")

    def totals():
        jobs.run_gmv_state(folder_stream(spark, path, "orders", max_files_per_batch=1), checkpoint, jobs.UNTIL_DRAINED).awaitTermination()
        return {(r.create_date, r.create_hour): float(r.gmv) for r in jobs.gmv_state_view(spark, checkpoint).collect()}

    assert totals() == {("2022-04-27", "03"): 5.5, ("2022-04-27", "04"): 8.0}
    feed(order(5, "0.25"))
    assert totals() == {("2022-04-27", "03"): 5.75, ("2022-04-27", "04"): 8.0}


def test_a_new_checkpoint_starts_at_the_stored_positions(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "topic string, partition int, offset bigint, value string"
    rows = [("o", n % 3, n // 3, order(n, "1")) for n in range(30)]
    write(folder, 0, rows[:9], spark, schema)
    write(folder, 1, rows[9:14], spark, schema)
    first, second = (jobs.ledger_table(str(tmp_path / "t"), r) for r in ("first", "second"))

    def run(table, checkpoint, since=None):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        jobs.run_gmv_ledger(stream, table, str(checkpoint), since, jobs.UNTIL_DRAINED).awaitTermination()

    run(first, tmp_path / "c1")
    forget_batch(tmp_path / "c1", 1)
    run(first, tmp_path / "c1")
    positions = jobs.ledger_positions(spark, first)
    assert {tuple(r) for r in positions.collect()} == {("o", 0, 5), ("o", 1, 5), ("o", 2, 4)}
    write(folder, 2, rows[14:] + [("p", 0, 0, order(99, "5"))], spark, schema)
    run(second, tmp_path / "c2", positions)
    total = jobs.ledger_view(spark, first, second).agg(F.sum("gmv")).first()[0]
    assert float(total) == 35.0
    assert gmv.KEYS


def test_slices_keep_rows_without_an_order_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (7, "c")], "n int, v string")
    for df, n in ((rows, 3), (rows.limit(0), 0)):
        stream = catalog._sliced(df, F.col("n"))
        table = jobs.BatchTable(catalog.new_work_dir(spark, "copy"), "n int, v string")
        jobs._each_batch(stream, table.write, "copy", catalog.new_work_dir(spark, "c"), jobs.UNTIL_DRAINED).awaitTermination()
        assert table.read(spark).count() == n


def test_triggers_of_one_user_are_dealt_by_pane(spark):
    rows = [("m", "hot", RULE.trigger, None, BASE + 1000 * n) for n in range(3000)] * 2 + [("m", f"u{n}", RULE.trigger, None, BASE) for n in range(50)]
    actions = spark.createDataFrame(rows, "mid string, uid string, action_id string, item string, ts bigint")
    panes = alerts._trigger_panes(actions, RULE)
    assert panes.count() == 100 + 50
    plan = panes._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange")[-1]
    assert "HashAggregate" in below and "REPARTITION_BY_COL" not in plan
