"""Leakage-safe churn features per account and prediction date.

A prediction date ``d`` is an end-of-day cut-off: everything up to and
including day ``d`` may be used, the label looks at the days after it.

A direct join of snapshots with all earlier events would repeat each event for
every later snapshot.  Instead each event day is mapped to the few prediction
dates whose 60-day window it falls in, plus the first date it is known at,
which carries it forward.  The map is made from the list of prediction dates
and has at most a few rows per calendar day, so it is broadcast; lifetime values are then running totals over an account's
prediction dates, of which there is one per month.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subsight.functions.expr import latest_by, month_start, months_between_inclusive, ratio, sum_where
from subsight.operators.usage import as_usage
from subsight.schemas import AUDIT_COLUMNS, FEATURE_COLUMNS, LABEL

_EVENT_WINDOW_DAYS = 60
_BILLING_WINDOW_DAYS = 90


def prediction_spine(subscriptions: DataFrame, invoices: DataFrame) -> DataFrame:
    """Every subscription on every month start on which it was paid and open.

    Dates run from the month after the first paid start to the month of the
    last invoice.
    """
    paid = subscriptions.where(F.col("subscription_start_date").isNotNull()).select(
        "account_id", "subscription_start_date", "cancellation_date"
    )
    first_date = paid.agg(F.add_months(month_start(F.min("subscription_start_date")), 1)).scalar()
    last_date = invoices.agg(month_start(F.max("invoice_date"))).scalar()
    start, cancel = F.col("subscription_start_date"), F.col("cancellation_date")
    # first month start on or after the paid start; last one before cancelling
    opening = F.add_months(month_start(F.date_sub(start, 1)), 1)
    closing = month_start(F.date_sub(cancel, 1))  # least skips NULL
    bounded = paid.withColumns({"first": F.greatest(first_date, opening), "last": F.least(last_date, closing)})
    return bounded.select(
        "account_id",
        F.explode(months_between_inclusive(F.col("first"), F.col("last"))).alias("prediction_date"),
        "subscription_start_date",
        "cancellation_date",
    )


def current_snapshots(dim_account: DataFrame, as_of: date) -> DataFrame:
    """Active accounts on one date."""
    return dim_account.where(F.col("subscription_status") == "active").select(
        "account_id", F.lit(as_of).alias("prediction_date"), "subscription_start_date", "cancellation_date"
    )


def prediction_dates(snapshots: DataFrame) -> list[date]:
    """The distinct prediction dates, one per month of history."""
    return sorted(row[0] for row in snapshots.select("prediction_date").distinct().collect() if row[0])


def _date_map(spark: SparkSession, dates: Sequence[date], window_days: int) -> DataFrame:
    """(day, prediction_date, in_window, first_known) for the given dates.

    At most ``window_days`` rows per prediction date plus one per day between
    dates: the size follows the calendar, not the data.  All days before the
    first window share one key, see :func:`_known_at`.
    """
    rows = []
    for position, current in enumerate(dates):
        opens = current - timedelta(days=window_days - 1)
        previous = dates[position - 1] if position else opens - timedelta(days=2)
        day = min(opens, previous + timedelta(days=1))
        while day <= current:
            rows.append((day, current, day >= opens, day > previous))
            day += timedelta(days=1)
    return spark.createDataFrame(rows, "day date, prediction_date date, in_window boolean, first_known boolean")


def _known_at(df: DataFrame, day: Column, dates: Sequence[date], window_days: int) -> DataFrame:
    """Repeat each row for the prediction dates it matters to."""
    earliest = F.lit(dates[0] - timedelta(days=window_days)) if dates else F.lit(None).cast("date")
    last = F.lit(dates[-1]) if dates else F.lit(None).cast("date")
    keyed = df.where(day <= last).withColumn("day", F.greatest(day, earliest))
    # Proven bound: a few rows per calendar day.
    return keyed.join(F.broadcast(_date_map(df.sparkSession, dates, window_days)), "day")


def _event_parts(events: DataFrame, dates: Sequence[date]) -> DataFrame:
    usage = _known_at(as_usage(events), F.col("event_date"), dates, _EVENT_WINDOW_DAYS)
    age = F.datediff("prediction_date", "event_date")
    name, weight = F.col("event_name"), F.col("events")
    recent, previous = age <= 29, (age >= 30) & (age <= 59)

    def sums(condition, alias):
        return sum_where(condition, weight).alias(alias)

    def known_max(condition, alias):
        return F.max(F.when(F.col("first_known") & condition, F.col("last_at"))).alias(alias)

    per_user = usage.groupBy("account_id", "user_id", "prediction_date").agg(
        sums(age <= 6, "events_last_7d"),
        sums(recent, "events_last_30d"),
        sums(previous, "events_previous_30d"),
        sums(recent & (name == "report_created"), "reports_created_last_30d"),
        sums(previous & (name == "report_created"), "reports_created_previous_30d"),
        sums(recent & (name == "report_exported"), "reports_exported_last_30d"),
        sums(recent & (name == "dashboard_viewed"), "dashboard_views_last_30d"),
        sums(recent & (name == "invite_sent"), "invites_sent_last_30d"),
        sums(F.col("first_known") & (name == "integration_connected"), "new_integrations"),
        known_max(F.lit(True), "new_latest_event_at"),
        known_max(name == "report_created", "new_latest_report_at"),
        known_max(name == "user_login", "new_latest_login_at"),
    )
    user = F.col("user_id")
    summed = [c for c in per_user.columns if c.startswith(("events_", "reports_", "dashboard_", "invites_", "new_int"))]
    return per_user.groupBy("account_id", "prediction_date").agg(
        *[F.sum(c).alias(c) for c in summed],
        F.count(F.when(F.col("events_last_30d") > 0, user)).alias("active_users_last_30d"),
        F.count(F.when(F.col("events_previous_30d") > 0, user)).alias("active_users_previous_30d"),
        *[F.max(f"new_latest_{k}_at").alias(f"new_latest_{k}_at") for k in ("event", "report", "login")],
    )


def _billing_parts(invoices: DataFrame, dates: Sequence[date]) -> DataFrame:
    columns = ("account_id", "invoice_id", "invoice_date", "billing_period_start", "plan", "amount", "payment_status")
    known = _known_at(invoices.select(*columns), F.col("invoice_date"), dates, _BILLING_WINDOW_DAYS)
    failed = F.col("payment_status") == "failed"
    first = F.col("first_known")
    order = (F.col("billing_period_start"), F.col("invoice_id"))

    def latest(column):
        return latest_by(F.when(first, F.col(column)), *order)

    return known.groupBy("account_id", "prediction_date").agg(
        F.count(F.when(failed & F.col("in_window"), F.lit(1))).alias("failed_payments_last_90d"),
        F.count(F.when(failed & first, F.lit(1))).alias("new_failed_payments"),
        F.max(F.when(first, F.col("invoice_date"))).alias("new_latest_invoice_date"),
        latest("plan").alias("new_plan"),
        latest("amount").alias("new_amount"),
        latest("payment_status").alias("new_payment_status"),
    )


_WINDOWED = (
    "events_last_7d",
    "events_last_30d",
    "events_previous_30d",
    "active_users_last_30d",
    "active_users_previous_30d",
    "reports_created_last_30d",
    "reports_created_previous_30d",
    "reports_exported_last_30d",
    "dashboard_views_last_30d",
    "invites_sent_last_30d",
    "failed_payments_last_90d",
)
_CARRIED_SUMS = {"new_integrations": "integrations_connected", "new_failed_payments": "total_failed_payments"}
_CARRIED_MAXIMA = {
    "new_latest_event_at": "latest_event_at",
    "new_latest_report_at": "latest_report_at",
    "new_latest_login_at": "latest_login_at",
    "new_latest_invoice_date": "latest_invoice_date",
    "new_plan": "latest_plan",
    "new_amount": "latest_amount",
    "new_payment_status": "latest_payment_status",
}


def _signals(events: DataFrame, invoices: DataFrame, snapshots: DataFrame, dates: Sequence[date]) -> DataFrame:
    """Event and billing signals on the snapshot rows, one shuffle by account.

    Snapshots, event parts and billing parts are stacked instead of joined.
    Per account there is at most one row of each part per prediction date, so
    the windows stay small for any account.
    """
    markers = snapshots.withColumn("is_snapshot", F.lit(True))
    stacked = markers.unionByName(_event_parts(events, dates), allowMissingColumns=True).unionByName(
        _billing_parts(invoices, dates), allowMissingColumns=True
    )
    same_date = Window.partitionBy("account_id", "prediction_date")
    so_far = (
        Window.partitionBy("account_id")
        .orderBy("prediction_date")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    zero = F.lit(0).cast("bigint")
    return (
        stacked.withColumns(
            {
                **{target: F.coalesce(F.sum(c).over(so_far), zero) for c, target in _CARRIED_SUMS.items()},
                **{target: F.max(c).over(so_far) for c, target in _CARRIED_MAXIMA.items()},
            }
        )
        .withColumns({c: F.coalesce(F.sum(c).over(same_date), zero) for c in _WINDOWED})
        .where("is_snapshot")
        .drop("is_snapshot", *_CARRIED_SUMS, *_CARRIED_MAXIMA)
    )


def churn_features(
    snapshots: DataFrame,
    accounts: DataFrame,
    events: DataFrame,
    invoices: DataFrame,
    activation: DataFrame,
    horizon_days: int | None = 30,
    dates: Sequence[date] | None = None,
) -> DataFrame:
    """Thirty features per snapshot with audit columns and the churn label.

    ``horizon_days=None`` leaves the label out, for scoring.  Audit columns are
    the latest event and invoice used; they are not model inputs.  ``dates``
    are the prediction dates of the snapshots; they are looked up (one row per
    month) when not given.
    """
    dates = prediction_dates(snapshots) if dates is None else sorted(dates)
    d = F.col("prediction_date")
    account = accounts.select(
        "account_id",
        F.col("plan").alias("account_plan"),
        "company_size",
        "seats_purchased",
        "acquisition_channel",
        "account_created_at",
    )
    milestones = activation.select(
        "account_id",
        F.col("is_activated").alias("activated"),
        "activation_date",
        F.col("days_to_activation").alias("activation_days"),
    )
    joined = _signals(events, invoices, snapshots, dates).join(account, "account_id").join(milestones, "account_id", "left")

    last, previous = F.col("events_last_30d"), F.col("events_previous_30d")
    change = last - previous
    known_activation = F.col("activation_date") <= d
    failed = F.col("latest_payment_status.value") == "failed"

    def since(column):
        return F.datediff(d, F.col(column).cast("date"))

    derived = joined.select(
        "account_id",
        "prediction_date",
        F.coalesce("latest_plan.value", "account_plan").alias("plan"),
        "company_size",
        "seats_purchased",
        "acquisition_channel",
        since("account_created_at").alias("account_age_days"),
        *[c for c in _WINDOWED if c != "failed_payments_last_90d"],
        "integrations_connected",
        since("latest_event_at").alias("days_since_last_activity"),
        since("latest_report_at").alias("days_since_last_report"),
        since("latest_login_at").alias("days_since_last_login"),
        change.alias("event_change_30d"),
        F.when(previous > 0, ratio(change, previous))
        .otherwise(F.when(last > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .alias("event_change_pct"),
        (F.col("active_users_last_30d") - F.col("active_users_previous_30d")).alias("active_user_change"),
        (F.col("reports_created_last_30d") - F.col("reports_created_previous_30d")).alias("report_activity_change"),
        ratio(F.col("active_users_last_30d"), F.col("seats_purchased")).alias("seat_utilization"),
        "failed_payments_last_90d",
        "total_failed_payments",
        F.coalesce(failed, F.lit(False)).cast("int").alias("recent_payment_failed"),
        F.coalesce(F.col("latest_amount.value"), F.lit(0)).cast("decimal(12,2)").alias("monthly_revenue"),
        (F.col("activated") & known_activation).cast("int").alias("is_activated"),
        F.when(known_activation, F.col("activation_days")).alias("days_to_activation"),
        "latest_event_at",
        "latest_invoice_date",
        *([] if horizon_days is None else [_label(d, horizon_days).alias(LABEL)]),
    )
    keys = ("account_id", "prediction_date")
    label = () if horizon_days is None else (LABEL,)
    return derived.select(*keys, *FEATURE_COLUMNS, *AUDIT_COLUMNS, *label)


def _label(prediction_date: Column, horizon_days: int) -> Column:
    cancel = F.col("cancellation_date")
    soon = (cancel > prediction_date) & (cancel <= F.date_add(prediction_date, horizon_days))
    return F.coalesce(soon, F.lit(False)).cast("int")


def current_scoring_features(
    dim_account: DataFrame,
    events: DataFrame,
    invoices: DataFrame,
    activation: DataFrame,
    as_of: date | None = None,
) -> DataFrame:
    """The same features for accounts that are active now, without a label.

    The date is the latest event date unless given; it is looked up first, so
    that the plan works with a constant.
    """
    day = as_of or as_usage(events).agg(F.max("event_date")).first()[0]
    snapshots = current_snapshots(dim_account, day)
    dates = [day] if day else []
    return churn_features(snapshots, dim_account, events, invoices, activation, horizon_days=None, dates=dates)


def training_dataset(features: DataFrame) -> DataFrame:
    """Feature rows in export order."""
    return features.orderBy("prediction_date", "account_id")


def training_summary(features: DataFrame) -> DataFrame:
    """Class balance and date range of a training set."""
    positive = F.coalesce(F.sum(LABEL), F.lit(0)).cast("bigint")
    return features.agg(
        F.count("*").alias("total_rows"),
        positive.alias("churn_rows"),
        (F.count("*") - positive).alias("non_churn_rows"),
        F.avg(LABEL).alias("churn_rate"),
        F.min("prediction_date").alias("first_prediction_date"),
        F.max("prediction_date").alias("last_prediction_date"),
    )


def leakage_check(features: DataFrame, subscriptions: DataFrame, horizon_days: int = 30) -> DataFrame:
    """Rows that used data from after the cut-off or carry a wrong label."""
    d = F.col("prediction_date")
    cancel = subscriptions.select("account_id", "cancellation_date")
    expected = _label(d, horizon_days)
    problem = (
        F.when(F.col("latest_event_at").cast("date") > d, "event after cutoff")
        .when(F.col("latest_invoice_date") > d, "invoice after cutoff")
        .when(F.coalesce(F.col("cancellation_date") <= d, F.lit(False)), "already cancelled")
        .when(F.col(LABEL) != expected, "label differs")
    )
    return (
        features.select("account_id", "prediction_date", "latest_event_at", "latest_invoice_date", LABEL)
        .join(cancel, "account_id", "left")
        .withColumn("problem", problem)
        .where(F.col("problem").isNotNull())
        .select("account_id", "prediction_date", "problem")
    )
