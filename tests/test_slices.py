"""The streams over the test tables: which rows a batch holds, and how many batches there are."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stream_commerce.plans import catalog
from stream_commerce.streaming import jobs


@pytest.fixture
def small_slices(monkeypatch):
    monkeypatch.setattr(catalog, "SLICE_ROWS", 100)
    monkeypatch.setattr(catalog, "FILE_ROWS", 50, raising=False)


def batches(spark, stream):
    """(batch, rows, lowest n, highest n) of each batch of a stream with a column n."""
    table = jobs.BatchTable(catalog.new_work_dir(spark, "copy"), "n bigint")
    jobs._each_batch(stream, table.write, "copy", catalog.new_work_dir(spark, "c"), jobs.UNTIL_DRAINED).awaitTermination()
    found = table.read(spark).groupBy("batch_id").agg(F.count("*"), F.min("n"), F.max("n")).orderBy("batch_id").collect()
    return [tuple(r) for r in found]


def test_many_slices_make_few_batches(spark, small_slices):
    found = batches(spark, catalog._sliced(spark.range(12_000).toDF("n"), F.col("n")))
    assert found == [(0, 2000, 0, 1999), (1, 2000, 2000, 3999), (2, 2000, 4000, 5999), (3, 2000, 6000, 7999),
                     (4, 2000, 8000, 9999), (5, 2000, 10_000, 11_999)]


def test_thirds_stay_thirds(spark, small_slices):
    found = batches(spark, catalog._sliced(spark.range(12_000).toDF("n"), F.col("n"), thirds=True))
    assert found == [(0, 4000, 0, 3999), (1, 4000, 4000, 7999), (2, 4000, 8000, 11_999)]


def test_user_state_rewrites_its_table_three_times(spark, small_slices, tmp_path, monkeypatch):
    spark.sql("""
      select id * 4 o_orderkey, id o_custkey, 'F' o_orderstatus, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id div 10 as int)) o_orderdate,
        '1-URGENT' o_orderpriority from range(9000)""").write.parquet(str(tmp_path / "orders.parquet"))
    written = []
    monkeypatch.setattr(jobs.KeyedTable, "write", lambda self, df, batch, own=jobs.KeyedTable.write: written.append(batch) or own(self, df, batch))
    catalog.stream_user_state(spark, str(tmp_path))
    assert written == [0, 1, 2]


def test_a_batch_named_by_its_slice_stays_one_slice(spark, monkeypatch):
    monkeypatch.setattr(catalog, "SLICE_ROWS", 6000)
    monkeypatch.setattr(catalog, "FILE_ROWS", 2000, raising=False)
    stream = catalog._sliced(spark.range(24_000).toDF("n"), F.col("n"), each=True)
    assert batches(spark, stream) == [(i, 6000, i * 6000, i * 6000 + 5999) for i in range(4)]


@pytest.mark.parametrize("name", ["stream_log_counts", "stream_unreadable_counts"])
def test_batches_of_one_slice_run_side_by_side(spark, small_slices, tmp_path, monkeypatch, name):
    spark.sql("""
      select id event_id, timestamp_ntz'2024-01-01 00:00:00' ts, id % 9 user_id, case id % 4 when 0 then 'signup' when 1 then 'error'
        else 'click' end event_type, 1.5D value, '{"k": 1}' props from range(1330)""").write.parquet(str(tmp_path / "events.parquet"))
    active = []
    monkeypatch.setattr(jobs, "start", lambda *a, own=jobs.start: [own(*a), active.append(len(spark.streams.active))][0])
    found = {r["batch"]: tuple(r)[1:] for r in catalog.QUERIES[name](spark, str(tmp_path)).collect()}
    slices = {i: [k for k in range(1330) if k // 95 == i] for i in range(14)}  # 1,330 ids in 14 slices of 95
    if name == "stream_log_counts":
        wanted = {i: (len(x), sum(k % 4 == 0 for k in x), 2 * sum(k % 4 > 1 for k in x)) for i, x in slices.items()}
    else:
        wanted = {i: (len(x), sum(k % 10 == 3 for k in x)) for i, x in slices.items()}
    assert found == wanted
    assert len(active) == 3


def test_uneven_slices_keep_their_order(spark, small_slices):
    rows = spark.range(900).toDF("n").unionByName(spark.range(1_000_000, 1_000_300).toDF("n"))
    found = batches(spark, catalog._sliced(rows, F.col("n")))
    assert sum(r[1] for r in found) == 1200
    assert all(a[3] < b[2] for a, b in zip(found, found[1:]))


def test_two_sides_come_in_step(spark, small_slices):
    few, many = spark.range(0, 6000, 10).toDF("n"), spark.range(6000).toDF("n")
    left, right = catalog._sliced_together([(few, F.col("n")), (many, F.col("n"))], pace=1)
    mine, theirs = batches(spark, left), batches(spark, right)
    assert [b[0] for b in mine] == [b[0] for b in theirs] == [0, 1, 2]
    assert all(a[2] == b[2] and a[3] <= b[3] < c[2] for a, b, c in zip(mine, theirs, [*mine[1:], (3, 0, 6000, 0)]))


def test_a_dealt_batch_lies_in_files_of_a_slice(spark, small_slices, monkeypatch):
    made = {}
    monkeypatch.setattr(catalog, "new_work_dir", lambda s, label, own=catalog.new_work_dir: made.setdefault(label, own(s, label)))
    catalog._sliced(spark.range(12_000).toDF("n"), F.col("n"))
    dealt = spark.read.parquet(made["dealt"])
    rows = [r["count"] for r in dealt.groupBy(F.input_file_name()).count().collect()]
    assert max(rows) <= 100 and sum(rows) == 12_000


@pytest.mark.parametrize("name", ["stream_first_starts_state", "stream_unpaired", "stream_gmv_state"])
def test_state_partitions_stay_few_whatever_is_asked(spark, tmp_path, monkeypatch, name):
    spark.sql("""
      select id event_id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) ts, id % 9 user_id,
        case id % 3 when 0 then 'signup' when 1 then 'click' else 'purchase' end event_type, 1.5D value, '{"k": 1}' props
      from range(90)""").write.parquet(str(tmp_path / "events.parquet"))
    made = []
    monkeypatch.setattr(catalog, "new_work_dir", lambda s, label, own=catalog.new_work_dir: made.append((label, own(s, label))) or made[-1][1])
    monkeypatch.setattr(catalog, "STATE_TASKS", 3, raising=False)
    asked = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        catalog.QUERIES[name](spark, str(tmp_path)).collect()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "7"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", asked)
    checkpoint = dict(made)["checkpoint"]
    state = spark.read.format("state-metadata").load(checkpoint)
    assert {r["numPartitions"] for r in state.select("numPartitions").collect()} == {3}


def test_sales_leave_no_copies_behind(spark, small_slices, tmp_path, monkeypatch):
    for name, rows in {
        "orders": "select id o_orderkey, id % 50 o_custkey, 'F' o_orderstatus, 1.5D o_totalprice, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) o_orderdate from range(300)",
        "lineitem": "select id div 3 l_orderkey, cast(id % 3 as int) l_linenumber, id % 7 l_partkey, 2.5D l_extendedprice, 4D l_quantity from range(900)",
        "part": "select id p_partkey, concat('p', id) p_name from range(7)",
        "customer": "select id c_custkey, concat('c', id) c_name, 'BUILDING' c_mktsegment, 1D c_acctbal, 3 c_nationkey from range(50)",
        "nation": "select id n_nationkey, concat('n', id) n_name, 1L n_regionkey from range(25)",
    }.items():
        spark.sql(rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    made, asked = [], {}
    monkeypatch.setattr(catalog, "BATCH_SLICES", 1)
    monkeypatch.setattr(catalog, "new_work_dir", lambda s, label, own=catalog.new_work_dir: made.append((label, own(s, label))) or made[-1][1])
    names = ["spark.sql.streaming.minBatchesToRetain", "spark.sql.streaming.stateStore.minDeltasForSnapshot",
             "spark.sql.classic.shuffleDependency.fileCleanup.enabled"]
    before = {x: spark.conf.get(x) for x in names}
    monkeypatch.setattr(jobs, "run_sales", lambda *a, own=jobs.run_sales: asked.update({x: spark.conf.get(x) for x in names}) or own(*a))
    found = catalog.stream_sales(spark, str(tmp_path))
    assert found.count() == 900 and found.select("order_detail_id").distinct().count() == 900
    # Both copies of the messages go while the query runs; the newest files may outlast it.
    assert [spark.read.schema("value string").parquet(path).count() for label, path in made if label == "dealt"] == [0, 0]
    for path in (path for label, path in made if label == "slices"):
        assert spark.read.schema("value string").parquet(path).count() <= 200
    # As older states do, and shuffle files.
    assert asked == dict(zip(names, ["2", "2", "true"]))
    assert {x: spark.conf.get(x) for x in names} == before
