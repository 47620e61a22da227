"""Parquet tables written one micro-batch at a time, with Spark's own partitioned reader and writer.

A `BatchTable` gives each batch the folder `batch_id=N`, which a replay overwrites, so a batch that is
replayed after a failure leaves exactly one copy of its rows. What a job keeps (a running total, devices
seen) is a view that folds the batches.

A `DatedTable` puts the folders of a date together, so the history of a date is pruned to its files.

A `KeyedTable` holds the current row of each key in a fixed number of hash buckets. A batch rewrites only
the buckets it touches, so readers fold nothing and the number of files does not grow with the batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stream_commerce.operators.latest import last_per_key

BATCH_ID = "batch_id"
FOLDER_FILES = 16
VERSION, COPY, BUCKET = "_version", "_copy", "_bucket"
Fold = Callable[[DataFrame], DataFrame]


def _struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _below(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows below a folder; none if there is no such folder yet."""
    try:
        found = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], schema)
    return found.select(*schema.fieldNames())


class BatchTable:
    """`run` names one life of the checkpoint: batch ids start again at 0 when a checkpoint is
    discarded, so a job that starts over with a new checkpoint must use a new run."""

    def __init__(
        self,
        path: str,
        schema: T.StructType | str,
        partition_by: Sequence[str] = (),
        run: str = "main",
        files: int | None = None,
    ):
        """`files` is the most files that a batch of a query with state puts into a folder."""
        self.schema = _struct(schema)
        self.partition_by = list(partition_by)
        self.files = files
        self.root = path.rstrip("/")
        self.run = run
        self.batches = f"{self.root}/batches/run={run}"

    def _columns(self) -> list[str]:
        return self.schema.fieldNames()

    def _full(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(BATCH_ID, T.LongType())])

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Few files per folder: AQE joins small partitions and splits a hot one by size. The batches of a query
        with state run without AQE, which drops the hint, and each of their tasks would write to every folder."""
        if self.files is None or rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            return rows.hint("rebalance", *self.partition_by)
        tasks = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * self.files)
        return rows.repartition(tasks, *self.partition_by, F.pmod(F.xxhash64(*rows.columns), F.lit(self.files)))

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Replace the rows of `batch_id`."""
        rows = df.select(*self._columns())
        if self.partition_by:
            rows = self._dealt(rows)
        writer = rows.write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.batches}/{BATCH_ID}={batch_id}")

    def rows(self, spark: SparkSession, batch_id: int) -> int:
        """Number of rows of one batch."""
        return spark.read.schema(self.schema).parquet(f"{self.batches}/{BATCH_ID}={batch_id}").count()

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """All rows with their `batch_id`; with `before`, only rows of earlier batches.

        A batch must read its own history with `before` set to its id, otherwise a replay would
        see what it wrote the first time. What a running write has not committed is not read.
        """
        rows = _below(spark, self.batches, self._full())
        return rows if before is None else rows.filter(F.col(BATCH_ID) < before)


class DatedTable(BatchTable):
    """A table whose batches need the history of the dates they hold, and of no others.

    Folders are DATE/batch_id=N. A batch counts for readers once its id stands in `done`, since its
    folders are committed one after the other.
    """

    def __init__(self, path: str, schema: T.StructType | str, date: str, run: str = "main"):
        super().__init__(path, schema, [date], run)
        self.date = date
        self.done = f"{self.root}/done/run={run}"

    def history(self, spark: SparkSession, dates: Sequence[str], before: int) -> DataFrame:
        """Rows of earlier batches on these dates: one scan, pruned to their folders. They are complete,
        since batches follow each other."""
        rows = _below(spark, self.batches, self._full())
        return rows.filter(F.col(self.date).isin(list(dates)) & (F.col(BATCH_ID) < before))

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Replace the rows of `batch_id`: a replay writes the same folders again."""
        spark = df.sparkSession
        rows = df.select(*self._columns()).withColumn(BATCH_ID, F.lit(batch_id).cast("bigint"))
        writer = rows.hint("rebalance", self.date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(self.date, BATCH_ID).parquet(self.batches)
        spark.range(1).select(F.lit(batch_id).cast("bigint").alias(BATCH_ID)).coalesce(1).write.mode(
            "overwrite").parquet(f"{self.done}/{batch_id}")

    def rows(self, spark: SparkSession, batch_id: int, dates: Sequence[str] | None = None) -> int:
        found = _below(spark, self.batches, self._full()) if dates is None else self.history(spark, dates, batch_id + 1)
        return found.filter(F.col(BATCH_ID) == batch_id).count()

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        done = _below(spark, f"{self.done}/*", T.StructType.fromDDL(f"{BATCH_ID} bigint")).distinct()
        rows = _below(spark, self.batches, self._full()).join(done, BATCH_ID, "left_semi").select(*self._full().fieldNames())
        return rows if before is None else rows.filter(F.col(BATCH_ID) < before)


class KeyedTable:
    """The last row of each key by `order`, in `buckets` hash buckets.

    A bucket lies in one of two copies. A batch merges its rows with the current copy of every bucket it
    touches and overwrites the other copy, which then is the newer one. So the state before the newest batch
    is still there for its replay, and there are never more than two folders per bucket. Readers take the
    newer copy; one that outlasts two batches may find its files replaced and has to read again.
    """

    def __init__(
        self, path: str, schema: T.StructType | str, keys: Sequence[str], order: Sequence[str],
        buckets: int = 16, run: str = "main",
    ):
        self.schema = _struct(schema)
        self.keys, self.order, self.buckets = list(keys), list(order), buckets
        self.path = f"{path.rstrip('/')}/current/run={run}"

    def _stored(self, spark: SparkSession) -> DataFrame:
        own = [T.StructField(VERSION, T.LongType()), T.StructField(COPY, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())]
        return _below(spark, self.path, T.StructType([*self.schema.fields, *own]))

    def _newest(self, spark: SparkSession, before: int | None) -> dict[int, tuple[int, int]]:
        """Version and copy of each bucket: at most one row per bucket reaches the driver."""
        rows = self._stored(spark)
        if before is not None:
            rows = rows.filter(F.col(VERSION) < before)
        newest = rows.groupBy(BUCKET).agg(F.max(F.struct(VERSION, COPY)).alias("at")).collect()
        return {r[BUCKET]: (r["at"][VERSION], r["at"][COPY]) for r in newest}

    @staticmethod
    def _in(newest: dict[int, tuple[int, int]], buckets: set[int]) -> Column:
        """Rows of the newest copies of these buckets; both columns are folders, so others are not read."""
        found = F.lit(False)
        for copy in (0, 1):
            own = sorted(b for b in buckets if b in newest and newest[b][1] == copy)
            if own:
                found = found | ((F.col(COPY) == copy) & F.col(BUCKET).isin(own))
        return found

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Merge a batch into the table; a replay of the newest batch leaves the same rows."""
        spark = df.sparkSession
        columns = self.schema.fieldNames()
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        fresh = last_per_key(df.select(*columns), self.keys, self.order).withColumn(BUCKET, bucket).persist()
        try:
            touched = {r[0] for r in fresh.select(BUCKET).distinct().collect()}
            if not touched:
                return
            newest = self._newest(spark, batch_id)
            old = self._stored(spark).filter(self._in(newest, touched)).select(*columns, BUCKET)
            merged = last_per_key(fresh.unionByName(old), [*self.keys, BUCKET], self.order)
            first = [b for b in touched if b in newest and newest[b][1] == 0]
            copy = F.when(F.col(BUCKET).isin(first), 1).otherwise(0) if first else F.lit(0)
            rows = merged.withColumns({VERSION: F.lit(batch_id).cast("bigint"), COPY: copy})
            rows.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                COPY, BUCKET).parquet(self.path)
        finally:
            fresh.unpersist()

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The current row of each key; with `before`, as it was before that (the newest) batch."""
        newest = self._newest(spark, before)
        return self._stored(spark).filter(self._in(newest, set(newest))).select(*self.schema.fieldNames())


def add_up(keys: Sequence[str], *sums: str) -> Fold:
    """Fold for additive tables: sums per key."""

    def fold(rows: DataFrame) -> DataFrame:
        totals = [F.sum(s).cast(rows.schema[s].dataType).alias(s) for s in sums]
        return rows.groupBy(*keys).agg(*totals, F.max(BATCH_ID).alias(BATCH_ID))

    return fold


def keep_last(keys: Sequence[str], *order: str) -> Fold:
    """Fold for keyed upserts: the row of the last batch per key."""
    def fold(rows: DataFrame) -> DataFrame:
        return last_per_key(rows, keys, [BATCH_ID, *order])

    return fold
