"""Session settings the operators rely on.

Calendar arithmetic is done in UTC, so the session time zone is part of the
contract.  Everything else here is a performance default that the caller (or
the cluster) may already have chosen; those are left alone when set.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
}

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark's own default holds all state in executor memory
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required runtime settings to an existing session.

    The performance defaults only where the session has none of its own.
    """
    for key, value in _REQUIRED.items():
        spark.conf.set(key, value)
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("subsight")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary one: on a cluster
    every executor would write to its own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        local = spark.sparkContext.master.split("[")[0] == "local"
        if not configured and not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = configured or tempfile.mkdtemp(prefix="subsight-checkpoint-")
        spark.sparkContext.setCheckpointDir(current)
    return configured or current


def stable(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint.

    Used where a result is read more than once and must not be recomputed
    differently, e.g. after range partitioning, whose bounds come from a
    sample.  Survives executor loss because the data is on shared storage.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
