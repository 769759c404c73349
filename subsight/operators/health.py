"""Run history and data freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_health(runs: DataFrame) -> DataFrame:
    """Latest success, failure and completion of each job in a run log.

    ``runs`` has job, state and ended_at; unfinished runs are ignored.
    """
    def latest(state: str) -> Column:
        return F.max(F.when(F.col("state") == state, F.col("ended_at")))

    return (
        runs.where(F.col("state").isin("success", "failed") & F.col("ended_at").isNotNull())
        .groupBy("job")
        .agg(
            latest("success").alias("last_success_at"),
            latest("failed").alias("last_failure_at"),
            F.max("ended_at").alias("last_completion_at"),
        )
    )


def freshness(table: DataFrame, timestamp: str, now: Column) -> DataFrame:
    """Latest timestamp of a table and its age in seconds, never negative."""
    latest = F.max(timestamp)
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(latest.cast("timestamp"))
    return table.agg(
        latest.alias("latest_at"),
        F.coalesce(F.greatest(age / F.lit(1e6), F.lit(0.0)), F.lit(0.0)).alias("age_seconds"),
    )
