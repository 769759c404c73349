"""Batch writers.  A table is written in full beside the old one and takes its
place by a rename once it is complete, so a failed or repeated job leaves
either the old or the new data.  Dated partitions are replaced by Spark's dynamic
overwrite, which stages them and moves them on commit."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight.operators.scoring import in_rank_order
from subsight.operators.snapshots import parse_logical_date, snapshots_for_dates
from subsight.schemas import PRIMARY_KEYS
from subsight.sources.tables import require_models


def replace_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> str:
    """Replace what is at ``path``; the old table stays if the job fails.

    The new one is written to ``<path>.new``.  Between the two renames a reader
    may find no table for a moment, never a part of one; a run that stops there
    leaves the old table at ``<path>.old``, which the next run puts back.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    here, new, old = (jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + end) for end in ("", ".new", ".old"))
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(here) and fs.exists(old):
        fs.rename(old, here)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(new.toString())
    fs.delete(old, True)
    if fs.exists(here) and not fs.rename(here, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, here):
        fs.rename(old, here)
        raise OSError(f"cannot put the new table at {path}")
    fs.delete(old, True)
    return path


def write_table(df: DataFrame, folder: str, name: str) -> str:
    """Full refresh of one mart."""
    return replace_table(df, f"{folder}/{name}")


def write_marts(marts: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    return {name: write_table(df, folder, name) for name, df in marts.items()}


def export_bundle(marts: Mapping[str, DataFrame], required: Iterable[str], folder: str) -> dict[str, str]:
    """Write the required marts as one bundle; refuse if any is missing."""
    required = list(required)
    require_models(marts, required)
    return write_marts({name: marts[name] for name in required}, folder)


def _replace_dates(df: DataFrame, path: str) -> None:
    """Overwrite only the dates present in ``df``.

    Adaptive execution sizes the writers by bytes: small dates share one, a
    large date gets as many as it needs.
    """
    (
        df.withColumn("date", F.col("snapshot_date"))
        .hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def backfill(dataset: str, df: DataFrame, days: Iterable[str | date], root: str) -> str:
    """Write the snapshots of many dates in one job.

    Each date comes out as a single-date run would leave it; a date on which
    nothing existed becomes an empty partition.  Null or repeated keys stop the
    run before anything is replaced: one pass over the keys finds them and the
    dates that have rows.
    """
    parsed = [d if isinstance(d, date) else parse_logical_date(d) for d in days]
    snapshot = snapshots_for_dates(dataset, df, parsed)
    key = PRIMARY_KEYS[dataset]
    keys = snapshot.groupBy("snapshot_date", key).agg(F.count(F.lit(1)).alias("rows"))
    checked = keys.groupBy("snapshot_date").agg(
        F.max(F.when(F.col(key).isNull(), F.lit("null"))).alias("empty"),
        F.max(F.when(F.col(key).isNotNull() & (F.col("rows") > 1), F.lit("duplicate"))).alias("repeated"),
    )
    # one row per date
    found = checked.collect()
    for problem in ("null", "duplicate"):
        if any(problem in (r.empty, r.repeated) for r in found):
            raise ValueError(f"{problem} {key} among the rows of a {dataset} snapshot")
    path = f"{root}/{dataset}"
    _replace_dates(snapshot, path)
    for day in sorted(set(parsed) - {r.snapshot_date for r in found}):
        snapshot.limit(0).write.mode("overwrite").parquet(f"{path}/date={day.isoformat()}")
    return path


def write_snapshot(dataset: str, df: DataFrame, day: str | date, root: str) -> str:
    """Build and replace one dated snapshot; rerunning a date changes nothing."""
    return backfill(dataset, df, [day], root)


def export_training_set(features: DataFrame, path: str) -> None:
    """Feature rows by prediction date, sorted by account inside each file."""
    ordered = features.repartitionByRange("prediction_date", "account_id").sortWithinPartitions(
        "prediction_date", "account_id"
    )
    replace_table(ordered, path, ["prediction_date"])


def write_scores(scores: DataFrame, path: str) -> None:
    """Score table in rank order (file by file)."""
    replace_table(in_rank_order(scores), path)


def append_run_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").parquet(path)
