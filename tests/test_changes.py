from __future__ import annotations

import json

from pyspark.sql import functions as F

from stream_commerce.operators import changes
from stream_commerce.schemas import ORDER_DETAIL_TOPIC, ORDER_INFO_TOPIC, ROW_CHANGE
from stream_commerce.streaming import jobs, sinks

DAY = 86_400_000


def image(**columns):
    return [(k, v) for k, v in columns.items()]


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROW_CHANGE)


ROWS = [
    ("order_info", "ROWDATA", "INSERT", 1, DAY, [image(id="1", total_amount="5.0"), image(id="2", note=None)]),
    ("order_info", "ROWDATA", "UPDATE", 2, DAY, [image(id="1")]),
    ("order_info", "ROWDATA", "DELETE", 3, DAY, [image(id="1")]),
    ("order_info", "TRANSACTIONEND", "INSERT", 4, DAY, [image(id="9")]),
    ("order_detail", "ROWDATA", "INSERT", 5, DAY, [image(id="7", order_id="1")]),
    ("order_detail", "ROWDATA", "UPDATE", 6, DAY, [image(id="7")]),
    ("user_info", "ROWDATA", "INSERT", 7, DAY, [image(id="u", user_level="1")]),
    ("user_info", "ROWDATA", "UPDATE", 8, 2 * DAY, [image(id="u", user_level="2"), image(id="u", user_level="3")]),
    ("user_info", "ROWDATA", "DELETE", 9, 2 * DAY, [image(id="u", user_level="4")]),
    ("other", "ROWDATA", "INSERT", 10, DAY, [image(id="1")]),
]


def test_only_read_changes_reach_a_topic(spark):
    found = sorted((r.topic, r.value) for r in changes.topic_rows(frame(spark, *ROWS)).collect())
    assert found == [
        (ORDER_DETAIL_TOPIC, '{"id":"7","order_id":"1"}'),
        (ORDER_INFO_TOPIC, '{"id":"1","total_amount":"5.0"}'), (ORDER_INFO_TOPIC, '{"id":"2"}'),
    ]
    only = changes.order_inserts(frame(spark, *ROWS)).collect()
    assert {r.topic for r in only} == {ORDER_INFO_TOPIC} and len(only) == 2


def test_last_row_of_a_user_wins_and_expires_after_a_week(spark):
    latest = changes.latest_users(changes.user_rows(frame(spark, *ROWS)))
    assert [(r.id, json.loads(r.value)["user_level"]) for r in latest.collect()] == [("u", "3")]
    assert changes.unexpired(latest, 9 * DAY - 1).count() == 1
    assert changes.unexpired(latest, 9 * DAY).count() == 0


def test_streams_fill_topics_and_user_state(spark, tmp_path):
    source = str(tmp_path / "source")
    frame(spark, *ROWS[:7]).coalesce(1).write.parquet(source)
    frame(spark, *ROWS[7:]).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(ROW_CHANGE).option("maxFilesPerTrigger", 1).parquet(source)
    out = str(tmp_path / "topics")
    jobs.run_change_topics(
        stream, lambda rows: sinks.folder_writer(rows, out), str(tmp_path / "c1"), jobs.UNTIL_DRAINED
    ).awaitTermination()
    written = spark.read.schema("value string, topic string").text(out)
    assert {(r.topic, r.value) for r in written.collect()} == {
        (r.topic, r.value) for r in changes.topic_rows(frame(spark, *ROWS)).collect()
    }
    state = jobs.user_table(str(tmp_path / "users"))
    jobs.run_user_state(stream, state, str(tmp_path / "c2"), jobs.UNTIL_DRAINED).awaitTermination()
    assert [(r.id, r.user_level) for r in jobs.user_view(spark, state, 3 * DAY).collect()] == [("u", "3")]


def test_a_column_named_twice_has_its_last_value(spark):
    for policy in ("LAST_WIN", "EXCEPTION"):
        spark.conf.set("spark.sql.mapKeyDedupPolicy", policy)
        try:
            rows = spark.sql("""select array(named_struct('name', 'id', 'value', '1'), named_struct('name', 'id', 'value', '2'),
                             named_struct('name', 'x', 'value', cast(null as string))) after""")
            found = rows.select(changes.after_json(F.col("after")), changes.after_value(F.col("after"), "id"),
                                changes.after_value(F.col("after"), "none")).first()
        finally:
            spark.conf.unset("spark.sql.mapKeyDedupPolicy")
        assert tuple(found) == ('{"id":"2"}', "2", None)
