"""Billing periods, export order, pre-cancellation decline and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsight.operators.usage import as_usage
from subsight.schemas import ENGAGEMENT_LEVELS, EVENT_NAMES, PLANS


def billing_schedule(subscriptions: DataFrame, end: Column) -> DataFrame:
    """Monthly billing periods of paid subscriptions up to ``end`` (inclusive).

    Periods are anchored on the start day, so a subscription from the 31st
    bills on the last day of short months and returns to the 31st.  A period
    ends the day before the next starts and is cut off at cancellation.
    """
    start, cancel = F.col("subscription_start_date"), F.col("cancellation_date")
    last_day = F.least(end, F.coalesce(F.date_sub(cancel, 1), end))
    number = F.floor(F.months_between(last_day, start)).cast("int") + 1
    paid = subscriptions.where(start.isNotNull() & (start <= last_day))
    numbered = paid.withColumn("period_number", F.explode(F.sequence(F.lit(0), number)))
    begins = F.add_months(start, F.col("period_number"))
    ends = F.date_sub(F.add_months(start, F.col("period_number") + 1), 1)
    return numbered.select(
        "subscription_id",
        "account_id",
        "period_number",
        begins.alias("billing_period_start"),
        F.least(ends, F.coalesce(F.date_sub(cancel, 1), ends)).alias("billing_period_end"),
        last_day.alias("_last_day"),
    ).where(F.col("billing_period_start") <= F.col("_last_day")).drop("_last_day")


def drop_orphan_exports(events: DataFrame) -> DataFrame:
    """Leave out exports with no report created earlier in the same account.

    A report created at the same instant counts as earlier.  Only the first
    report per account matters, so there is no running scan over its events.
    """
    first_report = (
        events.where("event_name = 'report_created'")
        .groupBy("account_id")
        .agg(F.min("event_timestamp").alias("first_report_at"))
    )
    kept = (F.col("event_name") != "report_exported") | (F.col("first_report_at") <= F.col("event_timestamp"))
    return events.join(first_report, "account_id", "left").where(kept).select(*events.columns)


def pre_cancel_decline(events: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Events 29-56 days before cancellation against the last 28 days."""
    per_day = as_usage(events).groupBy("account_id", "event_date").agg(F.sum("events").alias("events"))
    cancelled = subscriptions.where("subscription_status = 'cancelled'").select("account_id", "cancellation_date")
    before = F.datediff("cancellation_date", "event_date")

    def between(low: int, high: int) -> Column:
        return F.coalesce(F.sum(F.when(before.between(low, high), F.col("events"))), F.lit(0)).cast("bigint")

    return per_day.join(cancelled, "account_id").agg(
        between(29, 56).alias("earlier_events"), between(1, 28).alias("final_events")
    )


def dataset_profile(accounts: DataFrame, events: DataFrame) -> DataFrame:
    """Counts per plan, engagement level and event name over their fixed lists,
    median seats per plan, mean events per engagement level and weekday share.

    Long form: (profile, label, value).
    """
    spark = accounts.sparkSession
    lists = [("plan", p) for p in PLANS] + [("engagement_level", e) for e in ENGAGEMENT_LEVELS]
    lists += [("event_name", n) for n in EVENT_NAMES]
    spine = spark.createDataFrame(lists, "profile string, label string")

    usage = as_usage(events)
    labelled = F.explode(
        F.array(
            F.struct(F.lit("plan").alias("profile"), F.col("plan").alias("label")),
            F.struct(F.lit("engagement_level").alias("profile"), F.col("engagement_level").alias("label")),
        )
    )
    account_counts = accounts.select(labelled.alias("p")).groupBy("p.profile", "p.label").agg(F.count("*").alias("n"))
    event_counts = usage.groupBy(F.col("event_name").alias("label")).agg(F.sum("events").alias("n"))
    counted = account_counts.unionByName(event_counts.select(F.lit("event_name").alias("profile"), "label", "n"))
    counts = spine.join(counted, ["profile", "label"], "left").select(
        "profile", "label", F.coalesce("n", F.lit(0)).cast("double").alias("value")
    )

    seats = accounts.groupBy(F.col("plan").alias("label")).agg(F.median("seats_purchased").cast("double").alias("value"))
    per_account = usage.groupBy("account_id").agg(F.sum("events").alias("n"))
    busy = (
        accounts.select("account_id", F.col("engagement_level").alias("label"))
        .join(per_account, "account_id")
        .groupBy("label")
        .agg(F.avg("n").alias("value"))
    )
    on_weekday = F.weekday("event_date") < 5
    weekdays = usage.agg(
        (F.sum(F.when(on_weekday, F.col("events")).otherwise(0)).cast("double") / F.sum("events")).alias("value")
    )
    return (
        counts.unionByName(seats.select(F.lit("median_seats").alias("profile"), "label", "value"))
        .unionByName(busy.select(F.lit("average_events").alias("profile"), "label", "value"))
        .unionByName(weekdays.select(F.lit("weekday_share").alias("profile"), F.lit("all").alias("label"), "value"))
    )
