"""Volume and freshness of the landed stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsight.functions.expr import freshness_text, health_status


def stream_status(landing: DataFrame, now: Column, limit_seconds: int = 300) -> DataFrame:
    """One row about a file-backed landing table; ``now`` is passed in.

    Files without rows, such as the zero-row seed, do not count.
    """
    files = landing.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.max("event_timestamp").alias("latest")
    )
    # two narrow aggregates, one row each, instead of two distinct counts in one
    by_file = files.agg(
        F.count("*").alias("file_count"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.max("latest").alias("latest_event_timestamp"),
    )
    by_id = landing.select("event_id").where("event_id is not null").distinct().agg(F.count("*").alias("events_received"))
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros("latest_event_timestamp")) / F.lit(1e6)
    joined = by_file.unionByName(by_id, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("file_count", "total_rows", "events_received", "latest_event_timestamp")]
    )
    summary = joined.withColumn(
        "seconds_since_last_event",
        F.when(F.col("latest_event_timestamp").isNotNull(), F.greatest(age, F.lit(0.0))),
    )
    seconds = F.col("seconds_since_last_event")
    return summary.select(
        "*", freshness_text(seconds).alias("freshness"), health_status(seconds, limit_seconds).alias("status")
    )
