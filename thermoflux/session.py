"""Session construction for tests, benchmarks and local runs.

On a cluster the session is created by the platform; library code only reads
its settings.  ``ensure_checkpoint_dir`` honours an existing
``spark.checkpoint.dir`` (the shared folder the cluster names) and only sets a
scratch one when it is unset, as in tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# RocksDB is the state store the stateful-processor API expects.
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def export_package_path() -> None:
    """Let local Python workers import this package (stateful processors are pickled
    by reference).  On a cluster, ship it with ``--py-files`` instead."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    parts = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        os.environ["PYTHONPATH"] = os.pathsep.join([root] + parts)


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "thermoflux") -> SparkSession:
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    export_package_path()
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a scratch one only if unset."""
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; on a cluster it must name a shared folder")
    scratch = tempfile.mkdtemp(prefix="thermoflux-ckpt-", dir=os.environ.get("THERMOFLUX_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(scratch)
    return spark.sparkContext.getCheckpointDir() or scratch
