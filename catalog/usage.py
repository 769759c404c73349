"""Staging, activation, usage, dimensions."""

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.sql import ACTIVATION, ACTIVITY, ADOPTION, DIM_ACCOUNT, chain
from subsight.operators import activation as act
from subsight.operators import activity as usage
from subsight.operators.usage import daily_usage
from subsight.sources.events import merge_stream_into_events


def activation_of(d):
    return act.account_activation(d.accounts, d.events)


def activity_of(d):
    return usage.account_activity(d.accounts, d.users, d.events)


def dim_of(d):
    return usage.dim_account(d.accounts, d.subscriptions)


@query("stg_accounts", "SELECT * FROM accounts")
def _(d):
    return d.accounts


@query("stg_users", "SELECT * FROM users")
def _(d):
    return d.users


@query("stg_subscriptions", "SELECT * FROM subscriptions")
def _(d):
    return d.subscriptions


@query("stg_invoices", "SELECT * FROM invoices")
def _(d):
    return d.invoices


def landed(d):
    """Driver events as landed stream rows; every tenth id repeats a batch id."""
    return d.table("events").select(
        F.when(F.col("event_id") % 10 == 0, F.col("event_id").cast("string"))
        .otherwise(F.concat(F.lit("S"), F.col("event_id").cast("string")))
        .alias("event_id"),
        F.floor(F.col("user_id") / 5).cast("string").alias("account_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.lit("user_login").alias("event_name"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.lit(2).cast("bigint").alias("event_version"),
    )


_MERGED = """
    SELECT event_id, account_id, user_id, event_name, event_timestamp, event_version FROM product_events
    UNION ALL
    SELECT * FROM (
        SELECT CASE WHEN event_id % 10 = 0 THEN CAST(event_id AS VARCHAR) ELSE 'S' || event_id END AS event_id,
               CAST(user_id // 5 AS VARCHAR) AS account_id, CAST(user_id AS VARCHAR) AS user_id,
               'user_login' AS event_name, ts AS event_timestamp, 2 AS event_version
        FROM events) AS landed
    WHERE event_id NOT IN (SELECT event_id FROM product_events)"""


@query("stg_events_dedup", "SELECT * FROM product_events")
def _(d):
    return d.events


@query("merge_stream_into_events", _MERGED)
def _(d):
    return merge_stream_into_events(d.raw_events, landed(d))


@query(
    "daily_usage",
    """SELECT account_id, user_id, event_name, CAST(event_timestamp AS DATE) AS event_date, count(*) AS events,
              min(event_timestamp) AS first_at, max(event_timestamp) AS last_at
       FROM product_events GROUP BY ALL""",
)
def _(d):
    return daily_usage(d.events)


@query("account_activation", "SELECT * FROM activation", ACTIVATION)
def _(d):
    return activation_of(d)


@query(
    "mart_activation",
    "SELECT account_id, is_activated, activation_date, days_to_activation FROM activation",
    ACTIVATION,
)
def _(d):
    return act.mart_activation(activation_of(d))


@query(
    "activation_metrics",
    """SELECT count(*) AS total_accounts, count(*) FILTER (is_activated) AS activated_accounts,
              CAST(count(*) FILTER (is_activated) AS DOUBLE) / nullif(count(*), 0) AS activation_rate,
              CAST(median(days_to_activation) AS DOUBLE) AS median_days_to_activation
       FROM activation""",
    ACTIVATION,
)
def _(d):
    return act.activation_metrics(activation_of(d))


@query(
    "trial_conversion",
    """SELECT count(*) AS total_trial_accounts, count(subscription_start_date) AS converted_accounts,
              CAST(count(subscription_start_date) AS DOUBLE) / nullif(count(*), 0) AS trial_conversion_rate
       FROM subscriptions""",
)
def _(d):
    return act.trial_conversion(d.subscriptions)


@query(
    "weekly_active_accounts",
    """SELECT CAST(date_trunc('week', event_timestamp) AS DATE) AS week_start,
              count(DISTINCT account_id) AS active_accounts FROM product_events GROUP BY 1""",
)
def _(d):
    return usage.weekly_active_accounts(d.events)


@query(
    "monthly_active_accounts",
    """SELECT CAST(date_trunc('month', event_timestamp) AS DATE) AS month_start,
              count(DISTINCT account_id) AS active_accounts FROM product_events GROUP BY 1""",
)
def _(d):
    return usage.monthly_active_accounts(d.events)


@query("account_activity", "SELECT * FROM activity", ACTIVITY)
def _(d):
    return activity_of(d)


MART_ACTIVITY = """
mart_account_activity AS (
    SELECT account_id, total_events, number_of_active_users AS active_users, first_event_at, last_event_at,
           report_created_count, report_exported_count, dashboard_viewed_count, invite_sent_count,
           integration_connected_count, seats_purchased, provisioned_users, seat_utilization, activity_as_of_date,
           days_since_last_activity, events_last_7d, events_last_30d, active_users_last_30d
    FROM activity
)"""


@query("mart_account_activity", "SELECT * FROM mart_account_activity", chain(ACTIVITY, MART_ACTIVITY))
def _(d):
    return usage.mart_account_activity(activity_of(d))


@query("feature_adoption", "SELECT * FROM adoption", ADOPTION)
def _(d):
    return usage.feature_adoption(d.accounts, d.events)


@query("dim_account", "SELECT * FROM dim_account", DIM_ACCOUNT)
def _(d):
    return dim_of(d)


@query("dim_user", "SELECT * FROM users")
def _(d):
    return usage.dim_user(d.users)


@query("fact_product_events", "SELECT * FROM product_events")
def _(d):
    return usage.fact_product_events(d.events)


@query("fact_subscriptions", "SELECT * FROM subscriptions")
def _(d):
    return usage.fact_subscriptions(d.subscriptions)
