"""Contracted monthly revenue, revenue churn and net revenue retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subsight.functions.expr import latest_by, month_start, ratio

_WIDE_MONEY = "decimal(38,2)"


def account_monthly_revenue(invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Invoiced amount per account, billing month and subscription status.

    Failed and pending invoices count: this is contracted revenue, not cash.
    The plan is the one on the latest billing period of the month.
    """
    status = subscriptions.select("subscription_id", "subscription_status")
    return (
        invoices.select("invoice_id", "subscription_id", "account_id", "billing_period_start", "plan", "amount")
        .join(status, "subscription_id")
        .groupBy(
            "account_id",
            month_start(F.col("billing_period_start")).alias("month"),
            "subscription_status",
        )
        .agg(
            latest_by(F.col("plan"), F.col("billing_period_start"), F.col("invoice_id")).getField("value").alias("plan"),
            F.sum("amount").cast(_WIDE_MONEY).alias("monthly_revenue"),
        )
        .select("account_id", "month", "plan", "subscription_status", "monthly_revenue")
    )


def _month_to_month(revenue: DataFrame) -> DataFrame:
    """Each account's revenue of a month beside that of the month after.

    Revenue is first summed to one row per account and month (an account may
    have several subscriptions), so the window sees at most one row per month
    of history for any account.  ``has_current`` says whether there is a row at
    all in the later month.
    """
    per_month = revenue.groupBy("account_id", "month").agg(F.sum("monthly_revenue").alias("mrr"))
    order = Window.partitionBy("account_id").orderBy("month")
    following = F.add_months("month", 1)
    has_current = F.coalesce(F.lead("month").over(order) == following, F.lit(False))
    last_month = revenue.agg(F.max("month")).scalar()
    return (
        per_month.select(
            "account_id",
            following.alias("month"),
            F.col("mrr").alias("prior_mrr"),
            has_current.alias("has_current"),
            F.when(has_current, F.lead("mrr").over(order)).otherwise(F.lit(0)).alias("current_mrr"),
        )
        .where(F.col("month") <= last_month)
    )


def revenue_churn(revenue: DataFrame) -> DataFrame:
    """Prior-month revenue of accounts without any row this month."""
    lost = F.when(F.col("has_current"), F.lit(0)).otherwise(F.col("prior_mrr"))
    return (
        _month_to_month(revenue)
        .groupBy("month")
        .agg(
            F.sum("prior_mrr").cast(_WIDE_MONEY).alias("starting_mrr"),
            F.sum(lost).cast(_WIDE_MONEY).alias("churned_mrr"),
        )
        .where("starting_mrr > 0")
        .withColumn("revenue_churn_rate", ratio(F.col("churned_mrr"), F.col("starting_mrr")))
    )


def revenue_retention(revenue: DataFrame) -> DataFrame:
    """Revenue movements of last month's customers and net revenue retention.

    An account whose revenue fell to zero counts as churned here, while
    :func:`revenue_churn` asks for a missing row.
    """
    prior, current = F.col("prior_mrr"), F.col("current_mrr")

    def total(value):
        return F.sum(F.coalesce(value, F.lit(0))).cast(_WIDE_MONEY)

    return (
        _month_to_month(revenue)
        .groupBy("month")
        .agg(
            F.sum("prior_mrr").cast(_WIDE_MONEY).alias("starting_mrr"),
            total(F.when(current == 0, prior)).alias("churned_mrr"),
            total(F.when((current > 0) & (current < prior), prior - current)).alias("contraction_mrr"),
            total(F.when(current > prior, current - prior)).alias("expansion_mrr"),
            F.sum("current_mrr").cast(_WIDE_MONEY).alias("ending_mrr"),
        )
        .where("starting_mrr > 0")
        .withColumn("nrr", ratio(F.col("ending_mrr"), F.col("starting_mrr")))
    )


def churn_reconciliation(retention: DataFrame, churn: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Months in which the movements do not add up or the two churns disagree."""
    r, c = retention.alias("r"), churn.alias("c")
    identity = F.abs(
        F.col("ending_mrr")
        - (F.col("starting_mrr") - F.col("churned_mrr") - F.col("contraction_mrr") + F.col("expansion_mrr"))
    )
    unbalanced = retention.where(identity > tolerance).select(F.lit("nrr_identity").alias("metric"), "month")
    disagreeing = (
        r.join(c, F.col("r.month") == F.col("c.month"))
        .where(
            (F.abs(F.col("r.starting_mrr") - F.col("c.starting_mrr")) > tolerance)
            | (F.abs(F.col("r.churned_mrr") - F.col("c.churned_mrr")) > tolerance)
        )
        .select(F.lit("churn_reconciliation").alias("metric"), F.col("r.month").alias("month"))
    )
    return unbalanced.unionByName(disagreeing)
