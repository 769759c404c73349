"""Daily usage roll-up: the one pre-aggregation most operators can start from.

All time windows in the data model begin and end at midnight UTC, so a roll-up
by day loses nothing they need.  Operators accept either raw (deduplicated)
events or the stored roll-up: raw events are viewed as roll-up rows of weight
one, without aggregating, and partial aggregation does the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_usage(events: DataFrame) -> DataFrame:
    """View events as (account, user, name, day, weight, first, last) rows."""
    if "first_at" in events.columns:
        return events
    # text that is no time counts as none
    at = F.col("event_timestamp").try_cast("timestamp")
    return events.select(
        "account_id",
        "user_id",
        "event_name",
        at.cast("date").alias("event_date"),
        F.lit(1).cast("bigint").alias("events"),
        at.alias("first_at"),
        at.alias("last_at"),
    )


def daily_usage(events: DataFrame) -> DataFrame:
    """Roll deduplicated events up to account, user, event name and day."""
    return (
        as_usage(events)
        .groupBy("account_id", "user_id", "event_name", "event_date")
        .agg(
            F.sum("events").alias("events"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
        )
    )


def last_event_date(events: DataFrame):
    """Scalar subquery: the latest event date in the data."""
    return as_usage(events).agg(F.max("event_date")).scalar()
