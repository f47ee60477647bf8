"""Spark session and shared-folder helpers.

The library never creates machine-local scratch space on a cluster: lineage is
cut with ``DataFrame.checkpoint()`` into ``spark.checkpoint.dir`` (a shared
folder the cluster names).  Only when that setting is unset -- local tests --
do we point it at a fresh temporary folder.
"""

from __future__ import annotations

import os
import sys
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(app: str = "utxoflow", master: str | None = None, **conf: str) -> SparkSession:
    """Return the active session or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    builder = builder.master(master or os.environ.get("SPARK_MASTER", "local[8]"))
    for key, value in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a fresh temp folder only when unset."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="utxoflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (never ``localCheckpoint``)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)



_SCRATCH = threading.local()


@contextmanager
def scratch(spark: SparkSession):
    """Tables staged inside (by this thread) are removed at the end: for the
    micro-batches of a stream, which would leave them for ever."""
    before, root = getattr(_SCRATCH, "root", None), f"{checkpoint_dir(spark).rstrip('/')}/utxoflow-scratch-{uuid.uuid4().hex}"
    _SCRATCH.root = root
    try:
        yield
    finally:
        _SCRATCH.root = before
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage
    is cut, and readers still prune columns (unlike a checkpoint)."""
    root = getattr(_SCRATCH, "root", None) or checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/utxoflow-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pickle_by_value(module_name: str) -> None:
    """Serialize a module's functions and classes by value in Spark's
    cloudpickle, so Python workers (pandas steps, the stateful processor and
    its driver-side runner) need no install of this package."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def scale_conf(input_bytes: int, executors_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` on ``executors_cores`` cores:
    shuffle partitions sized so a partition is about ``target_partition_bytes``
    (at least 2 waves of tasks), scan splits of the same size, AQE on with the
    same advisory size so it can coalesce small and split skewed partitions."""
    parts = max(2 * executors_cores, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
