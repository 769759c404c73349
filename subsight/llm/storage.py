"""Intermediate tables in the shared folder, and their removal."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from subsight.session import shared_folder, stable


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table and go on from it.

    Unlike a checkpoint, its size is known: Spark broadcasts it in a join only
    if it is small enough, and shuffles it otherwise.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """A checkpoint behind which the shuffle files go at once.

    Once it stands, nothing reads them; otherwise they stay until the driver
    collects the plan.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return stable(df.select("*"))
    finally:
        conf.set(key, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark clean up after plans that nothing refers to any more.

    Shuffle files go when the objects that stand for them are collected, here
    and in the driver's JVM; with a large heap that may be long after their use.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
