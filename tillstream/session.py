"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when the operator above then needs its own shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# On executors: stream state outside the heap, checkpointed as changes. A batch run again is the last one, so few versions stay.
# They hold for the streams that `streaming/runs.py` starts.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # many small stores, none of which needs disk set aside
    # counting the rows in state costs a read before every write
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.minBatchesToRetain": "2",
    # one cache and one bound for all stores of an executor
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "600",
}
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; sizes and parallelism stay with the cluster."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def state_settings(spark: SparkSession) -> dict[str, str]:
    """Settings of a stream's state: none where all runs in one process, which `local-cluster` is not."""
    return {} if spark.sparkContext.master.partition("[")[0] == "local" else STATE_SETTINGS


def local_session(cpus: int | str = "*", name: str = "tillstream", **settings: str) -> SparkSession:
    """A single-machine session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config(SHUFFLE_PARTITIONS, "8" if cpus == "*" else str(cpus))
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared `spark.checkpoint.dir`, for stream state and written tables."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/tillstream/{purpose}-{uuid.uuid4().hex}"


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished queries, which otherwise stay on the executors' disks until the driver is short of memory."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
