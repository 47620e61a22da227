from __future__ import annotations

import pytest

from stream_commerce.streaming import jobs
from stream_commerce.streaming.batch_table import BatchTable, DatedTable, KeyedTable, add_up, keep_last

SCHEMA = "k string, v bigint, day string"


@pytest.fixture
def table(tmp_path):
    return BatchTable(str(tmp_path / "t"), SCHEMA, ["day"])


def put(spark, table, batch_id, *rows):
    table.write(spark.createDataFrame(list(rows), SCHEMA), batch_id)


def content(df):
    return sorted((r.k, r.v, r.day, r.batch_id) for r in df.collect())


def test_empty_table(spark, table):
    assert table.read(spark).count() == 0
    assert table.read(spark).columns == ["k", "v", "day", "batch_id"]


def test_a_batch_overwrites_itself_only(spark, table):
    put(spark, table, 0, ("a", 1, "d1"))
    put(spark, table, 1, ("a", 2, "d1"), ("b", 3, "d2"))
    put(spark, table, 1, ("a", 5, "d1"))
    assert content(table.read(spark)) == [("a", 1, "d1", 0), ("a", 5, "d1", 1)]
    assert content(table.read(spark, before=1)) == [("a", 1, "d1", 0)]


def test_tasks_of_a_batch_without_aqe_share_the_files_of_a_folder(spark, tmp_path):
    other = spark.newSession()  # as the session of a query with state
    other.conf.set("spark.sql.adaptive.enabled", "false")
    other.conf.set("spark.sql.shuffle.partitions", "20")
    rows = other.range(4000).repartition(20).selectExpr("'k' k", "id v", "concat('d', id % 5) day")
    assert [t(str(tmp_path)).files for t in (jobs.alert_table, jobs.suspect_table, jobs.first_start_table)] == [16] * 3
    table = BatchTable(str(tmp_path / "few"), SCHEMA, ["day"], files=2)
    table.write(rows, 0)
    found = table.read(spark)
    assert len(found.inputFiles()) <= 10 and found.distinct().count() == found.count() == 4000


def test_uncommitted_files_are_not_read(spark, table, tmp_path):
    put(spark, table, 0, ("a", 1, "d1"))
    put(spark, table, 1, ("a", 2, "d1"))
    batch = tmp_path / "t" / "batches" / "run=main" / "batch_id=1"
    staged = batch / "_temporary" / "0" / "day=d1"
    staged.mkdir(parents=True)
    for part in (batch / "day=d1").iterdir():
        part.rename(staged / part.name)
    assert content(table.read(spark)) == [("a", 1, "d1", 0)]


def test_runs_are_separate(spark, tmp_path):
    one, two = (BatchTable(str(tmp_path / "t"), SCHEMA, ["day"], run=r) for r in ("one", "two"))
    put(spark, one, 0, ("a", 1, "d1"))
    put(spark, two, 0, ("b", 1, "d1"))
    assert content(one.read(spark)) == [("a", 1, "d1", 0)]


@pytest.mark.parametrize("fold, expected", [
    (add_up(["k", "day"], "v"), [("a", 7, "d1"), ("b", 8, "d2")]),
    (keep_last(["k"]), [("a", 4, "d1"), ("b", 8, "d2")]),
])
def test_folds(spark, table, fold, expected):
    for batch, value in enumerate((1, 2, 4)):
        put(spark, table, batch, ("a", value, "d1"))
    put(spark, table, 3, ("b", 8, "d2"))
    assert sorted((r.k, r.v, r.day) for r in fold(table.read(spark)).collect()) == expected


def keyed(spark, table, batch_id, *rows):
    table.write(spark.createDataFrame(list(rows), "k string, seq bigint, v string"), batch_id)


def current(spark, table, before=None):
    return sorted(((r.k, r.seq, r.v) for r in table.read(spark, before).collect()), key=str)


def test_keyed_table_holds_the_last_row_of_each_key(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "k"), "k string, seq bigint, v string", ["k"], ["seq"], buckets=4)
    assert current(spark, table) == []
    keyed(spark, table, 0, ("a", 1, "x"), ("b", 5, "x"), (None, 1, "n"), ("a", 2, "y"))
    keyed(spark, table, 1, ("b", 3, "older"), ("c", 1, "x"))
    assert current(spark, table) == sorted([("a", 2, "y"), ("b", 5, "x"), ("c", 1, "x"), (None, 1, "n")], key=str)
    assert current(spark, table, before=1) == sorted([("a", 2, "y"), ("b", 5, "x"), (None, 1, "n")], key=str)
    for _ in range(2):  # a replay, with other rows than the attempt that failed
        keyed(spark, table, 2, ("a", 9, "z"), ("d", 1, "gone"))
    keyed(spark, table, 2, ("a", 9, "z"))
    assert [r for r in current(spark, table) if r[0] in ("a", "c")] == [("a", 9, "z"), ("c", 1, "x")]
    keyed(spark, table, 3)
    assert [r for r in current(spark, table) if r[0] == "a"] == [("a", 9, "z")]


def test_keyed_table_does_not_grow_with_batches(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "k"), "k string, seq bigint, v string", ["k"], ["seq"], buckets=2)
    sizes = []
    for batch in range(50):
        keyed(spark, table, batch, *[(f"k{n}", batch, "v") for n in range(6)])
        sizes.append(len(spark.read.parquet(table.path).inputFiles()))
    assert max(sizes[10:]) <= max(sizes[:10]) <= 4
    assert len(table.read(spark).inputFiles()) <= 4 and table.read(spark).count() == 6
    plan = table.read(spark)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "_copy" in filters and "_bucket" in filters


def test_history_of_many_dates_is_one_pruned_scan(spark, tmp_path):
    table = DatedTable(str(tmp_path / "d"), SCHEMA, "day")
    put(spark, table, 0, *[("a", n, f"d{n:03}") for n in range(30)])
    dates = [f"d{n:03}" for n in range(0, 800, 2)]
    history = table.history(spark, dates, 1)
    assert history.count() == 15
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan and "PartitionFilters" in plan


def test_partition_filter_reaches_the_scan(spark, table):
    put(spark, table, 0, ("a", 1, "d1"), ("b", 2, "d2"))
    files = table.read(spark).filter("day = 'd1'").inputFiles()
    plan = table.read(spark).filter("day = 'd1'")._jdf.queryExecution().executedPlan().toString()
    assert len(files) == 2 and "PartitionFilters: [isnotnull(day" in plan
