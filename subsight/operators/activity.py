"""Account activity, active accounts, feature adoption and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight.functions.expr import month_start, ratio, ratio_or_zero, sum_where, week_start
from subsight.operators.usage import as_usage, last_event_date
from subsight.schemas import ADOPTION_FEATURES, EVENTS, SUBSCRIPTIONS, USERS

_FEATURE_COUNTS = {
    "report_created_count": "report_created",
    "report_exported_count": "report_exported",
    "dashboard_viewed_count": "dashboard_viewed",
    "invite_sent_count": "invite_sent",
    "integration_connected_count": "integration_connected",
}


def account_activity(accounts: DataFrame, users: DataFrame, events: DataFrame) -> DataFrame:
    """One row per account, inactive ones included.

    Recency is measured from the latest event date in the data, not the wall
    clock.  Events are reduced per (account, user) first, which turns both
    distinct-user counts into plain sums, then per account, and only then
    joined: a very busy account is spread by user and by partial aggregation.
    """
    as_of = last_event_date(events)
    usage = as_usage(events).withColumn("as_of", as_of)
    age = F.datediff("as_of", "event_date")
    per_user = usage.groupBy("account_id", "user_id").agg(
        F.min("first_at").alias("first_event_at"),
        F.max("last_at").alias("last_event_at"),
        F.sum("events").alias("total_events"),
        *[sum_where(F.col("event_name") == name, F.col("events")).alias(c) for c, name in _FEATURE_COUNTS.items()],
        sum_where(age <= 6, F.col("events")).alias("events_last_7d"),
        sum_where(age <= 29, F.col("events")).alias("events_last_30d"),
    )
    counters = ["total_events", *_FEATURE_COUNTS, "events_last_7d", "events_last_30d"]
    per_account = per_user.groupBy("account_id").agg(
        F.min("first_event_at").alias("first_event_at"),
        F.max("last_event_at").alias("last_event_at"),
        *[F.sum(c).alias(c) for c in counters],
        F.count("user_id").alias("number_of_active_users"),
        F.count(F.when(F.col("events_last_30d") > 0, F.col("user_id"))).alias("active_users_last_30d"),
    )
    seats_in_use = users.groupBy("account_id").agg(F.count("*").alias("provisioned_users"))

    def zero(name: str):
        return F.coalesce(F.col(name), F.lit(0).cast("bigint"))

    return (
        accounts.select("account_id", "seats_purchased")
        .join(per_account, "account_id", "left")
        .join(seats_in_use, "account_id", "left")
        .withColumn("activity_as_of_date", as_of)
        .select(
            "account_id",
            "first_event_at",
            "last_event_at",
            zero("total_events").alias("total_events"),
            zero("number_of_active_users").alias("number_of_active_users"),
            *[zero(c).alias(c) for c in _FEATURE_COUNTS],
            "seats_purchased",
            zero("provisioned_users").alias("provisioned_users"),
            ratio(zero("number_of_active_users"), F.col("seats_purchased")).alias("seat_utilization"),
            "activity_as_of_date",
            F.datediff("activity_as_of_date", F.col("last_event_at").cast("date")).alias("days_since_last_activity"),
            zero("events_last_7d").alias("events_last_7d"),
            zero("events_last_30d").alias("events_last_30d"),
            zero("active_users_last_30d").alias("active_users_last_30d"),
        )
    )


def mart_account_activity(activity: DataFrame) -> DataFrame:
    return activity.select(
        "account_id",
        "total_events",
        F.col("number_of_active_users").alias("active_users"),
        "first_event_at",
        "last_event_at",
        *_FEATURE_COUNTS,
        "seats_purchased",
        "provisioned_users",
        "seat_utilization",
        "activity_as_of_date",
        "days_since_last_activity",
        "events_last_7d",
        "events_last_30d",
        "active_users_last_30d",
    )


def _active_accounts(events: DataFrame, period, name: str) -> DataFrame:
    return (
        as_usage(events)
        .select("account_id", period(F.col("event_date")).alias(name))
        .where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count_distinct("account_id").alias("active_accounts"))
    )


def weekly_active_accounts(events: DataFrame) -> DataFrame:
    """Distinct accounts per Monday week; events without a timestamp are left out."""
    return _active_accounts(events, week_start, "week_start")


def monthly_active_accounts(events: DataFrame) -> DataFrame:
    return _active_accounts(events, month_start, "month_start")


def _feature_spine(df: DataFrame) -> DataFrame:
    rows = [(name, position) for position, name in enumerate(ADOPTION_FEATURES, start=1)]
    return df.sparkSession.createDataFrame(rows, "feature_name string, display_order int")


def feature_usage(events: DataFrame) -> DataFrame:
    return (
        as_usage(events)
        .where(F.col("event_name").isin(*ADOPTION_FEATURES))
        .groupBy(F.col("event_name").alias("feature_name"))
        .agg(F.count_distinct("account_id").alias("accounts_using_feature"))
    )


def feature_adoption(accounts: DataFrame, events: DataFrame, zero_when_empty: bool = False) -> DataFrame:
    """Share of all accounts that ever used each of the five features.

    The fixed list keeps unused features with zero.  ``display_order`` carries
    the reporting order.
    """
    total = accounts.agg(F.count("*")).scalar()
    used = F.coalesce(F.col("accounts_using_feature"), F.lit(0).cast("bigint"))
    rate = ratio_or_zero if zero_when_empty else ratio
    return (
        _feature_spine(accounts)
        .join(feature_usage(events), "feature_name", "left")
        .select(
            "feature_name",
            used.alias("accounts_using_feature"),
            total.alias("total_accounts"),
            rate(used, total).alias("adoption_rate"),
            "display_order",
        )
    )


# --- dimensions and facts -----------------------------------------------------


def dim_account(accounts: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Account attributes with the status and price of the subscription."""
    current = subscriptions.select(
        "account_id",
        "subscription_status",
        "subscription_start_date",
        "cancellation_date",
        "monthly_price",
    )
    return accounts.join(current, "account_id", "left")


def dim_user(users: DataFrame) -> DataFrame:
    return users.select(*USERS.fieldNames())


def fact_product_events(events: DataFrame) -> DataFrame:
    return events.select(*EVENTS.fieldNames())


def fact_subscriptions(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.select(*SUBSCRIPTIONS.fieldNames())
