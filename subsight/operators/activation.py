"""Trial activation and trial conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight.functions.expr import count_where, ratio
from subsight.operators.usage import as_usage
from subsight.schemas import ACTIVATION_EVENTS


def account_activation(accounts: DataFrame, events: DataFrame, window_days: int = 14) -> DataFrame:
    """One row per account: first milestone times inside the trial window.

    The window is half open: trial days 0 .. window_days - 1 count.  An account
    is activated when all three milestones fall inside; the activation date is
    the day of the last of them.

    Milestones are first reduced to one row per account, name and day, so the
    join by account meets a few rows per day however busy an account is.
    """
    daily = (
        as_usage(events)
        .where(F.col("event_name").isin(*ACTIVATION_EVENTS))
        .groupBy("account_id", "event_name", "event_date")
        .agg(F.min("first_at").alias("first_at"))
    )
    a, m = accounts.alias("a"), daily.alias("m")
    in_window = (F.col("m.event_date") >= F.col("a.trial_start_date")) & (
        F.col("m.event_date") < F.date_add("a.trial_start_date", window_days)
    )

    def first(name: str):
        return F.min(F.when(F.col("m.event_name") == name, F.col("m.first_at")))

    times = (
        a.join(m, (F.col("a.account_id") == F.col("m.account_id")) & in_window, "left")
        .groupBy(F.col("a.account_id").alias("account_id"), F.col("a.trial_start_date").alias("trial_start_date"))
        .agg(
            first("workspace_created").alias("workspace_created_at"),
            first("invite_sent").alias("first_invite_sent_at"),
            first("integration_connected").alias("first_integration_connected_at"),
        )
    )
    moments = [F.col("workspace_created_at"), F.col("first_invite_sent_at"), F.col("first_integration_connected_at")]
    complete = moments[0].isNotNull() & moments[1].isNotNull() & moments[2].isNotNull()
    finished = F.when(complete, F.greatest(*moments).cast("date"))
    return times.select(
        "account_id",
        "trial_start_date",
        "workspace_created_at",
        "first_invite_sent_at",
        "first_integration_connected_at",
        finished.alias("activation_date"),
        complete.alias("is_activated"),
        F.datediff(finished, "trial_start_date").alias("days_to_activation"),
    )


def mart_activation(activation: DataFrame) -> DataFrame:
    return activation.select("account_id", "is_activated", "activation_date", "days_to_activation")


def activation_metrics(activation: DataFrame) -> DataFrame:
    """Total, activated, rate (NULL without accounts) and exact median days.

    Days to activation take at most ``window_days`` values, so the exact median
    keeps a handful of counters however many accounts there are.
    """
    return activation.agg(
        F.count("*").alias("total_accounts"),
        count_where(F.col("is_activated")).alias("activated_accounts"),
        ratio(count_where(F.col("is_activated")), F.count("*")).alias("activation_rate"),
        F.median(F.when(F.col("is_activated"), F.col("days_to_activation"))).alias("median_days_to_activation"),
    )


def trial_conversion(subscriptions: DataFrame) -> DataFrame:
    converted = F.count("subscription_start_date")
    return subscriptions.agg(
        F.count("*").alias("total_trial_accounts"),
        converted.alias("converted_accounts"),
        ratio(converted, F.count("*")).alias("trial_conversion_rate"),
    )
