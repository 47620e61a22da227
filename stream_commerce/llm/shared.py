"""Helpers that several operators use: cut lineage, columns under own names, texts to batches."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stream_commerce.config import new_work_dir

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Python workers stay alive between stages; freed arrays of 16 MB go back to the system at once. (From 1 MB on,
#: op13's arrays cost a quarter more CPU seconds in new pages.)
WORKER_ENV = {"MALLOC_MMAP_THRESHOLD_": "16777216", "MALLOC_TRIM_THRESHOLD_": "33554432", "MALLOC_ARENA_MAX": "2",
              "ARROW_DEFAULT_MEMORY_POOL": "system"}

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def with_path(run):
    """Let Python workers import this package from where the driver has it, and hold little memory.

    On a cluster the package is installed or shipped; where driver and workers share the folder, this
    spares the PYTHONPATH. Texts go to workers in batches of at most 8 MB, unless the session has a setting of its
    own: a batch is held several times over on its way.
    """

    @wraps(run)
    def call(spark: SparkSession, *args):
        root = str(Path(__file__).resolve().parents[2])
        known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
        if root not in known:
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in [root, *known] if x)
        for name, value in WORKER_ENV.items():
            spark.sparkContext.environment.setdefault(name, value)
        if spark.conf.get(BATCH_BYTES) == "67108864b":  # the default
            spark.conf.set(BATCH_BYTES, "8m")
        return run(spark, *args)

    return call


def tidy(run):
    """Let a worker's task give its memory back when it ends: the worker stays, and so would freed memory."""

    @wraps(run)
    def call(frames: Iterator) -> Iterator:
        try:
            yield from run(frames)
        finally:
            gc.collect()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only where the C library has it
            if trim is not None:
                trim(0)

    return call


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: short lineage that outlives executors. The shuffle
    files of the write go when it ends, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = new_work_dir(spark, label)
    asked = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, asked)
    return spark.read.schema(df.schema).parquet(path)


def texts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, under the names doc_id and text; a null text is empty."""
    return documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
