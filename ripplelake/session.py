"""Session settings the engine relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Needed for right results: all bucketing is done in UTC.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}

#: Sensible on a large cluster.  AQE starts from many small shuffle partitions, merges the
#: small ones and splits the skewed ones, so one setting serves a 10 MB and a 10 TB shuffle.
CLUSTER = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    # State of streaming aggregations on executors' disks instead of their heaps.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def cluster_session(name: str, **more: str) -> SparkSession:
    """A session with these settings; ``more`` adds to them or overrides them."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**CLUSTER, **REQUIRED, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else built."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, which the cluster names in ``spark.checkpoint.dir``.

    Only where none is named is a local one chosen, as in tests.  It also becomes the checkpoint folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="ripplelake-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder name in the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
