"""Session settings and the shared folder for data that outlives one job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a cluster job. Anything the caller or the cluster sets wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Start shuffles wide and let adaptive execution merge small partitions.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4096",
    # Times with Parquet statistics, so that reads for a range of time skip groups of rows; the default form has none.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # One state row per entity is kept on local disk, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's defaults; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the folder the cluster names in ``spark.checkpoint.dir``.

    Every executor must see it, so a machine-local folder is made only where they are threads of this process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
