"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Settings a job sets on its session. In batch AQE coalesces and splits shuffle partitions at run time,
# so spark.sql.shuffle.partitions only has to be large enough. A streaming query with state takes it
# from its first checkpoint and keeps it: see `--partitions` of the app.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.metricsEnabled": "true",
    # Join and window state is kept on local disk and in the checkpoint instead of the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def session_builder(app_name: str) -> SparkSession.Builder:
    """A builder with the job settings; the master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    return builder


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="stream-commerce-")


def work_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster. Only a local master may do without one."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    if not spark.conf.get("spark.master", "").startswith("local") or "cluster" in spark.conf.get("spark.master"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that the driver and all executors share")
    return _local_root()


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; the writer creates it."""
    return f"{work_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
