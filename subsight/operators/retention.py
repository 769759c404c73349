"""Cohort retention, logo churn, segments and behaviour of paid accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsight.functions.expr import (
    count_where,
    month_start,
    months_between_inclusive,
    ratio,
    ratio_or_zero,
    week_start,
    weeks_between_inclusive,
)
from subsight.operators.usage import as_usage
from subsight.schemas import LARGEST_SIZE_BUCKET, MEANINGFUL_EVENTS, SIZE_BUCKETS

def _zero(name: str):
    return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)


def retention_cohorts(accounts: DataFrame, events: DataFrame) -> DataFrame:
    """Weekly sign-up cohorts and the share active in each later week.

    Week zero is entry and always complete.  A later week needs a meaningful
    event.  Activity is reduced to distinct (account, week) pairs and counted
    per (cohort, week); only those counts meet the cohort calendar, so accounts
    are never multiplied by weeks.
    """
    usage = as_usage(events)
    last_week = usage.agg(week_start(F.max("event_date"))).scalar()
    entry = accounts.select("account_id", week_start(F.col("trial_start_date")).alias("cohort_week"))
    calendar = (
        entry.groupBy("cohort_week")
        .agg(F.count_distinct("account_id").alias("cohort_size"))
        .withColumn("last_week", last_week)
        .select(
            "cohort_week",
            "cohort_size",
            F.explode(weeks_between_inclusive(F.col("cohort_week"), F.col("last_week"))).alias("activity_week"),
        )
    )
    active = (
        usage.where(F.col("event_name").isin(*MEANINGFUL_EVENTS))
        .select("account_id", week_start(F.col("event_date")).alias("activity_week"))
        .distinct()
    )
    returned = (
        active.join(entry, "account_id")
        .where(F.col("activity_week") > F.col("cohort_week"))
        .groupBy("cohort_week", "activity_week")
        .agg(F.count_distinct("account_id").alias("returned_accounts"))
    )
    weeks = F.datediff("activity_week", "cohort_week") / 7
    retained = F.when(F.col("activity_week") == F.col("cohort_week"), F.col("cohort_size")).otherwise(
        F.coalesce("returned_accounts", F.lit(0).cast("bigint"))
    )
    return calendar.join(returned, ["cohort_week", "activity_week"], "left").select(
        "cohort_week",
        weeks.cast("int").alias("weeks_since_start"),
        "cohort_size",
        retained.alias("retained_accounts"),
        ratio(retained, F.col("cohort_size")).alias("retention_rate"),
    )


def logo_churn(subscriptions: DataFrame, events: DataFrame) -> DataFrame:
    """Paying accounts at the start, lost during and left at the end of each month.

    The cancellation date is exclusive: an account cancelled on the first of a
    month still starts that month.  Starting and cancelling inside one month is
    not churn.  Each subscription is laid out over the months it touches, so
    the cost follows subscription lifetimes instead of months times accounts.
    """
    last_month = as_usage(events).agg(month_start(F.max("event_date"))).scalar()
    start, cancel = F.col("subscription_start_date"), F.col("cancellation_date")
    paid = subscriptions.where(start.isNotNull()).select(
        "account_id",
        "subscription_start_date",
        "cancellation_date",
        month_start(start).alias("first_month"),
        F.least(last_month, month_start(cancel)).alias("final_month"),  # least skips NULL
    )
    touched = months_between_inclusive(F.col("first_month"), F.col("final_month"))
    laid_out = paid.withColumn("month", F.explode(touched))
    month = F.col("month")
    next_month = F.add_months(month, 1)
    open_at_start = (start < month) & (cancel.isNull() | (cancel >= month))
    flags = laid_out.groupBy("month", "account_id").agg(
        F.max(open_at_start.cast("int")).alias("starting"),
        F.max(F.coalesce((start < month) & (cancel >= month) & (cancel < next_month), F.lit(False)).cast("int")).alias(
            "churned"
        ),
        F.max((cancel.isNull() | (cancel >= next_month)).cast("int")).alias("ending"),
    )
    counts = flags.groupBy("month").agg(
        F.sum("starting").alias("starting_accounts"),
        F.sum("churned").alias("churned_accounts"),
        F.sum("ending").alias("ending_accounts"),
    )
    calendar = (
        paid.agg(F.min("first_month").alias("first"))
        .withColumn("last", last_month)
        .select(F.explode(months_between_inclusive(F.col("first"), F.col("last"))).alias("month"))
    )
    return (
        calendar.join(counts, "month", "left")
        .select("month", _zero("starting_accounts"), _zero("churned_accounts"), _zero("ending_accounts"))
        .withColumn("logo_churn_rate", ratio_or_zero(F.col("churned_accounts"), F.col("starting_accounts")))
    )


def _paid_accounts(dim_account: DataFrame) -> DataFrame:
    status = F.when(F.col("subscription_status") == "active", "retained").when(
        F.col("subscription_status") == "cancelled", "churned"
    )
    return dim_account.where(
        F.col("subscription_start_date").isNotNull() & F.col("subscription_status").isin("active", "cancelled")
    ).withColumn("retention_status", status)


def company_size_bucket(size: Column) -> Column:
    bucket = F.lit(LARGEST_SIZE_BUCKET)
    for limit, name in reversed(SIZE_BUCKETS):
        bucket = F.when(size <= limit, name).otherwise(bucket)
    return bucket


#: The breakdowns of :func:`retention_segments`.
SEGMENT_TYPES = ("plan", "engagement_level", "company_size", "acquisition_channel")


def retention_segments(dim_account: DataFrame) -> DataFrame:
    """Retained and churned paid accounts by plan, engagement, size and channel.

    All four breakdowns come from one pass: every account yields four
    (type, value) pairs which combine on the map side.
    """
    pairs = {
        "plan": F.col("plan"),
        "engagement_level": F.col("engagement_level"),
        "company_size": company_size_bucket(F.col("company_size")),
        "acquisition_channel": F.col("acquisition_channel"),
    }
    segment = F.explode(
        F.array(*[F.struct(F.lit(k).alias("segment_type"), v.alias("segment_value")) for k, v in pairs.items()])
    )
    retained = count_where(F.col("retention_status") == "retained")
    return (
        _paid_accounts(dim_account)
        .select("retention_status", segment.alias("segment"))
        .groupBy("segment.segment_type", "segment.segment_value")
        .agg(
            F.count("*").alias("total_accounts"),
            retained.alias("retained_accounts"),
            count_where(F.col("retention_status") == "churned").alias("churned_accounts"),
            ratio(retained, F.count("*")).alias("retention_rate"),
        )
    )


def retention_behavior(dim_account: DataFrame, activity: DataFrame) -> DataFrame:
    """Average activity of retained against churned paid accounts."""
    averages = {
        "avg_total_events": "total_events",
        "avg_active_users": "active_users",
        "avg_seat_utilization": "seat_utilization",
        "avg_reports_created": "report_created_count",
        "avg_reports_exported": "report_exported_count",
        "avg_integrations_connected": "integration_connected_count",
        "avg_dashboards_viewed": "dashboard_viewed_count",
        "avg_days_since_last_activity": "days_since_last_activity",
        "avg_events_last_7d": "events_last_7d",
        "avg_events_last_30d": "events_last_30d",
        "avg_active_users_last_30d": "active_users_last_30d",
    }
    return (
        _paid_accounts(dim_account)
        .select("account_id", "retention_status")
        .join(activity, "account_id")
        .groupBy("retention_status")
        .agg(
            F.count("*").alias("total_accounts"),
            *[F.avg(source).alias(name) for name, source in averages.items()],
        )
    )
