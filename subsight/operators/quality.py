"""Data-quality checks.  Every check returns the violating rows, so an empty
result means it passed.  ``quality_report`` counts many checks at once and is
the gate before scoring."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsight.functions.expr import latest_by, month_start
from subsight.schemas import ADOPTION_FEATURES, PLAN_PRICES, PLANS
from subsight.session import stable


class QualityGateError(RuntimeError):
    """Raised when checks fail that must pass before scoring."""


# --- generic checks -----------------------------------------------------------


def unique(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once; NULL keys are left to not_null."""
    present = df.where(F.col(keys[0]).isNotNull()) if len(keys) == 1 else df
    return present.groupBy(*keys).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def relationships(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-null key is unknown to the parent."""
    known = parent.select(F.col(parent_key or key).alias(key))
    return child.where(F.col(key).isNotNull()).join(known, key, "left_anti")


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows with a value outside the list; NULL passes."""
    return df.where(~F.col(column).isin(*values))


def _any(*conditions: Column) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def _outside_unit(name: str) -> Column:
    return (F.col(name) < 0) | (F.col(name) > 1)


# --- metric bounds --------------------------------------------------------------


def activity_bounds(activity: DataFrame) -> DataFrame:
    negative = [
        F.col(c) < 0
        for c in ("days_since_last_activity", "events_last_7d", "events_last_30d", "active_users_last_30d")
    ]
    more_in_week = F.col("events_last_7d") > F.col("events_last_30d")
    return activity.where(_any(_outside_unit("seat_utilization"), more_in_week, *negative)).select("account_id")


def activation_consistency(activation: DataFrame, window_days: int = 14) -> DataFrame:
    days, day = F.col("days_to_activation"), F.col("activation_date")
    milestones = ("workspace_created_at", "first_invite_sent_at", "first_integration_connected_at")
    incomplete = _any(*[F.col(c).isNull() for c in milestones], day.isNull(), days.isNull())
    return activation.where(
        _any(
            day < F.col("trial_start_date"),
            days < 0,
            days >= window_days,
            F.col("is_activated") & incomplete,
            ~F.col("is_activated") & (day.isNotNull() | days.isNotNull()),
        )
    )


def adoption_bounds(adoption: DataFrame) -> DataFrame:
    return adoption.where(_outside_unit("adoption_rate"))


def retention_bounds(cohorts: DataFrame, logo_churn: DataFrame) -> DataFrame:
    size, kept = F.col("cohort_size"), F.col("retained_accounts")
    bad_cohorts = cohorts.where(
        _any(
            size <= 0,
            kept < 0,
            kept > size,
            _outside_unit("retention_rate"),
            (F.col("weeks_since_start") == 0) & (F.col("retention_rate") != 1),
        )
    ).select(F.lit("cohort_retention").alias("metric"), F.col("cohort_week").cast("string").alias("period"))
    counts = [F.col(c) < 0 for c in ("starting_accounts", "churned_accounts", "ending_accounts")]
    bad_months = logo_churn.where(
        _any(*counts, F.col("churned_accounts") > F.col("starting_accounts"), _outside_unit("logo_churn_rate"))
    ).select(F.lit("logo_churn").alias("metric"), F.col("month").cast("string").alias("period"))
    return bad_cohorts.unionByName(bad_months)


def revenue_bounds(churn: DataFrame, retention: DataFrame, tolerance: float = 0.01) -> DataFrame:
    period = F.col("month").cast("string").alias("period")
    starting, churned = F.col("starting_mrr"), F.col("churned_mrr")
    bad_churn = churn.where(
        _any(starting < 0, churned < 0, churned > starting, _outside_unit("revenue_churn_rate"))
    ).select(F.lit("revenue_churn").alias("metric"), period)

    contraction, expansion, ending = F.col("contraction_mrr"), F.col("expansion_mrr"), F.col("ending_mrr")
    drift = F.abs(ending - (starting - churned - contraction + expansion))
    rate_drift = F.abs(F.col("nrr") - ending.cast("double") / F.nullif(starting.cast("double"), F.lit(0.0)))
    bad_retention = retention.where(
        _any(starting <= 0, churned < 0, contraction < 0, expansion < 0, ending < 0, drift > tolerance, rate_drift > 1e-6)
    ).select(F.lit("net_revenue_retention").alias("metric"), period)

    other = churn.select("month", F.col("starting_mrr").alias("other_starting"), F.col("churned_mrr").alias("other_churned"))
    apart = (
        retention.join(other, "month")
        .where(
            (F.abs(starting - F.col("other_starting")) > tolerance)
            | (F.abs(churned - F.col("other_churned")) > tolerance)
        )
        .select(F.lit("churn_reconciliation").alias("metric"), period)
    )
    return bad_churn.unionByName(bad_retention).unionByName(apart)


def churn_matches_cancellations(logo_churn: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Months whose churned logos differ from the cancellations of that month."""
    cancelled = (
        subscriptions.where(F.col("cancellation_date").isNotNull())
        .groupBy(month_start(F.col("cancellation_date")).alias("month"))
        .agg(F.count("*").alias("cancellations"))
    )
    expected = F.coalesce("cancellations", F.lit(0).cast("bigint"))
    return (
        logo_churn.join(cancelled, "month", "left")
        .where(F.col("churned_accounts") != expected)
        .select("month", "churned_accounts", expected.alias("cancellations"))
    )


def churn_feature_validity(features: DataFrame) -> DataFrame:
    d = F.col("prediction_date")
    counts = (
        "events_last_7d",
        "events_last_30d",
        "events_previous_30d",
        "active_users_last_30d",
        "reports_created_last_30d",
        "failed_payments_last_90d",
    )
    out_of_range = features.where(
        _any(
            F.col("latest_event_at").cast("date") > d,
            F.col("latest_invoice_date") > d,
            _outside_unit("seat_utilization"),
            *[F.col(c) < 0 for c in counts],
        )
    ).select("account_id", "prediction_date")
    repeated = unique(features, "account_id", "prediction_date").select("account_id", "prediction_date")
    return out_of_range.unionByName(repeated)


def metric_contract(
    accounts: DataFrame,
    activation: DataFrame,
    activation_metrics: DataFrame,
    conversion: DataFrame,
    adoption: DataFrame,
) -> DataFrame:
    """Rules the headline metrics must meet: one row per rule that is broken."""
    facts = activation.agg(
        F.count("*").alias("rows"),
        F.count_distinct("account_id").alias("ids"),
        F.count(
            F.when(
                F.col("is_activated") == (F.col("activation_date").isNull() | F.col("days_to_activation").isNull()),
                F.lit(1),
            )
        ).alias("mixed"),
        F.count(
            F.when((F.col("activation_date") < F.col("trial_start_date")) | (F.col("days_to_activation") < 0), F.lit(1))
        ).alias("early"),
    )
    expected = accounts.agg(F.count("*")).scalar()
    activation_rate = activation_metrics.agg(F.max("activation_rate")).scalar()
    conversion_rate = conversion.agg(F.max("trial_conversion_rate")).scalar()
    present = adoption.where(F.col("feature_name").isin(*ADOPTION_FEATURES))
    features_seen = present.agg(F.count_distinct("feature_name")).scalar()
    bad_rates = adoption.where(~F.coalesce(F.col("adoption_rate").between(0, 1), F.lit(False))).agg(F.count("*")).scalar()
    rules = {
        "one activation row per account": (F.col("rows") != expected) | (F.col("ids") != expected),
        "activation flag and dates agree": F.col("mixed") > 0,
        "activation follows trial start": F.col("early") > 0,
        "activation rate in range": ~F.coalesce(activation_rate.between(0, 1), F.lit(False)),
        "conversion rate in range": ~F.coalesce(conversion_rate.between(0, 1), F.lit(False)),
        "adoption rates in range": bad_rates > 0,
        "all features present": features_seen != len(ADOPTION_FEATURES),
    }
    broken = F.array(*[F.struct(F.lit(name).alias("rule"), failed.alias("broken")) for name, failed in rules.items()])
    return facts.select(F.explode(broken).alias("r")).where("r.broken").select("r.rule")


# --- billing, events and status -------------------------------------------------


def _tier(plan: Column) -> Column:
    ladder = F.lit(None).cast("int")
    for position, name in enumerate(PLANS):
        ladder = F.when(plan == name, position).otherwise(ladder)
    return ladder


def _price(plan: Column) -> Column:
    known = F.lit(None).cast("decimal(12,2)")
    for name, amount in PLAN_PRICES.items():
        known = F.when(plan == name, F.lit(amount).cast("decimal(12,2)")).otherwise(known)
    return known


def _billing_row_checks(invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    owner = subscriptions.select(
        "subscription_id", F.col("account_id").alias("owner"), "cancellation_date", F.lit(True).alias("known")
    )
    rules = {
        "invoice date is not period start": ~F.col("invoice_date").eqNullSafe(F.col("billing_period_start")),
        "period ends before it starts": F.col("billing_period_end") < F.col("billing_period_start"),
        "amount differs from plan price": ~F.col("amount").eqNullSafe(_price(F.col("plan"))),
        "unknown subscription": F.col("known").isNull(),
        "subscription of another account": F.col("account_id") != F.col("owner"),
        "billed on or after cancellation": F.col("billing_period_end") >= F.col("cancellation_date"),
    }
    broken = F.array_compact(F.array(*[F.when(failed, F.lit(name)) for name, failed in rules.items()]))
    return (
        invoices.join(owner, "subscription_id", "left")
        .select(F.col("invoice_id").alias("id"), F.explode(broken).alias("problem"))
        .select("problem", "id")
    )


def _billing_gaps(invoices: DataFrame) -> DataFrame:
    """Subscription dates at which one period should hand over to the next.

    Every period contributes its start and the day after its end.  In a
    history without gaps these meet one to one, except for the first start and
    the last end.  Counting both per date replaces a scan in billing order and
    combines before the shuffle.
    """
    marks = F.explode(
        F.array(
            F.struct(F.col("billing_period_start").alias("day"), F.lit(1).alias("starts"), F.lit(0).alias("ends")),
            F.struct(F.date_add("billing_period_end", 1).alias("day"), F.lit(0).alias("starts"), F.lit(1).alias("ends")),
        )
    )
    per_day = (
        invoices.select("subscription_id", marks.alias("m"))
        .groupBy("subscription_id", "m.day")
        .agg(F.sum("m.starts").alias("starts"), F.sum("m.ends").alias("ends"))
    )
    # one row per calendar day and subscription at most
    history = Window.partitionBy("subscription_id")
    first_start = F.min(F.when(F.col("starts") > 0, F.col("day"))).over(history)
    last_end = F.max(F.when(F.col("ends") > 0, F.col("day"))).over(history)
    handover = (F.col("starts") == 1) & (F.col("ends") == 1)
    opening = (F.col("starts") == 1) & (F.col("ends") == 0) & (F.col("day") == first_start)
    closing = (F.col("starts") == 0) & (F.col("ends") == 1) & (F.col("day") == last_end)
    return (
        per_day.withColumn("fine", handover | opening | closing)
        .where("not fine")
        .select(F.lit("billing periods do not meet").alias("problem"), F.concat_ws("@", "subscription_id", "day").alias("id"))
    )


def _tier_jumps(invoices: DataFrame) -> DataFrame:
    """Moves over more than one plan tier between consecutive billing dates."""
    per_day = invoices.groupBy("subscription_id", "billing_period_start").agg(
        F.min(_tier(F.col("plan"))).alias("low"), F.max(_tier(F.col("plan"))).alias("high")
    )
    # one row per calendar day and subscription at most
    order = Window.partitionBy("subscription_id").orderBy("billing_period_start")
    widest = F.greatest(
        F.col("high") - F.col("low"),
        F.col("high") - F.lag("low").over(order),
        F.lag("high").over(order) - F.col("low"),
    )
    return (
        per_day.withColumn("step", widest)
        .where("step > 1")
        .select(
            F.lit("plan tier skipped").alias("problem"),
            F.concat_ws("@", "subscription_id", "billing_period_start").alias("id"),
        )
    )


def billing_history_validity(invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Broken billing rules as (problem, id): invoice id, or subscription@date."""
    return (
        _billing_row_checks(invoices, subscriptions)
        .unionByName(_billing_gaps(invoices))
        .unionByName(_tier_jumps(invoices))
    )


def latest_plan_matches(accounts: DataFrame, subscriptions: DataFrame, invoices: DataFrame) -> DataFrame:
    """Accounts whose own or subscription plan is not the latest billed plan."""
    latest = invoices.groupBy("account_id").agg(
        latest_by(F.col("plan"), F.col("billing_period_start"), F.col("invoice_id")).getField("value").alias("billed_plan")
    )
    account_plan = accounts.select("account_id", F.col("plan").alias("account_plan"))
    subscription_plan = subscriptions.select("account_id", F.col("plan").alias("subscription_plan"))
    billed = F.col("billed_plan")
    return (
        latest.join(account_plan, "account_id", "left")
        .join(subscription_plan, "account_id", "left")
        .where(~billed.eqNullSafe(F.col("account_plan")) | ~billed.eqNullSafe(F.col("subscription_plan")))
        .select("account_id", "billed_plan", "account_plan", "subscription_plan")
    )


def event_validity(
    events: DataFrame, users: DataFrame, subscriptions: DataFrame, min_share_after_workspace: float = 0.95
) -> DataFrame:
    """Broken event rules as (problem, id); the id is an event or an account.

    The share of activity after workspace creation is a rule about the whole
    table and reports the id ``all``.

    One pass over events: each becomes a narrow row with the problems of its
    own, which is stored; what concerns accounts and the whole is summed from
    there.
    """
    at = F.col("event_timestamp")
    # a user normally has one account; several are tried in turn, so events do not multiply
    owners = users.groupBy("user_id").agg(F.collect_list(F.struct("account_id", "created_at")).alias("owners"))
    cancelled = subscriptions.groupBy("account_id").agg(F.min("cancellation_date").alias("cancelled_on"))

    def of_owner(owner: Column) -> Column:
        return F.array(
            F.when(owner["account_id"] != F.col("account_id"), F.lit("user of another account")),
            F.when(at < owner["created_at"], F.lit("event before user creation")),
        )

    known = F.flatten(F.transform("owners", of_owner))
    problems = F.concat(
        F.coalesce(known, F.array(F.lit("unknown user"))),
        F.array(F.when(at >= F.col("cancelled_on").cast("timestamp"), F.lit("event on or after cancellation"))),
    )
    judged = stable(
        events.select("event_id", "account_id", "user_id", "event_name", "event_timestamp")
        .join(owners, "user_id", "left")
        .join(cancelled, "account_id", "left")
        .select("event_id", "account_id", "event_name", "event_timestamp", F.array_compact(problems).alias("broken"))
    )
    rows = judged.select(F.explode("broken").alias("problem"), F.col("event_id").alias("id"))

    def first(name: str) -> Column:
        return F.min(F.when(F.col("event_name") == name, at))

    per_account = judged.groupBy("account_id").agg(
        F.count(F.when(F.col("event_name") == "workspace_created", F.lit(1))).alias("workspaces"),
        first("workspace_created").alias("workspace_at"),
        first("report_created").alias("report_at"),
        first("report_exported").alias("export_at"),
    )
    late_report = ~F.coalesce(F.col("report_at") < F.col("export_at"), F.lit(False))
    account_rules = F.array_compact(
        F.array(
            F.when(F.col("workspaces") > 1, F.lit("several workspaces")),
            F.when(F.col("export_at").isNotNull() & late_report, F.lit("export before any report")),
        )
    )
    accounts = per_account.select(F.explode(account_rules).alias("problem"), F.col("account_id").alias("id"))

    after = F.coalesce(at > F.col("workspace_at"), F.lit(False)).cast("int")
    share = (
        judged.where("event_name <> 'workspace_created'")
        .select("account_id", "event_timestamp")
        .join(per_account.select("account_id", "workspace_at"), "account_id", "left")
        .agg(F.avg(after).alias("share"))
        .where(F.col("share") < min_share_after_workspace)
        .select(F.lit("too much activity before workspace").alias("problem"), F.lit("all").alias("id"))
    )
    return rows.unionByName(accounts).unionByName(share)


def seat_and_status_validity(
    accounts: DataFrame, users: DataFrame, subscriptions: DataFrame, invoices: DataFrame
) -> DataFrame:
    """Broken seat, amount and subscription status rules as (problem, id)."""

    def found(df: DataFrame, problem: str, key: str) -> DataFrame:
        return df.select(F.lit(problem).alias("problem"), F.col(key).alias("id"))

    seats = accounts.select("account_id", "seats_purchased")
    counted = users.groupBy("account_id").agg(F.count("*").alias("users"))
    status, cancel = F.col("subscription_status"), F.col("cancellation_date")
    converted = subscriptions.where(status.isin("active", "cancelled")).select("account_id")
    checks = [
        found(counted.join(seats, "account_id").where("users > seats_purchased"), "more users than seats", "account_id"),
        found(accounts.where("seats_purchased < 0"), "negative seats", "account_id"),
        found(invoices.where("amount < 0"), "negative amount", "invoice_id"),
        found(
            subscriptions.where(cancel.isNotNull() != (status == "cancelled")),
            "cancellation date and status disagree",
            "subscription_id",
        ),
        found(
            subscriptions.where(
                (status == "cancelled") & ~F.coalesce(cancel > F.col("subscription_start_date"), F.lit(False))
            ),
            "cancelled before paid start",
            "subscription_id",
        ),
        found(
            invoices.select("account_id").distinct().join(converted, "account_id", "left_anti"),
            "invoice for a trial account",
            "account_id",
        ),
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


# --- report and gate --------------------------------------------------------------


def count_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations of many row rules from a single scan of a table."""
    counted = df.agg(*[F.count(F.when(failed, F.lit(1))).alias(name) for name, failed in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"`{n}`").alias("violations")) for n in rules])
    return counted.select(F.inline(pairs))


def quality_report(checks: Mapping[str, DataFrame], counted: Iterable[DataFrame] = ()) -> DataFrame:
    """One row per check: name, number of violating rows, whether it passed.

    ``checks`` are violating rows by name; ``counted`` are results of
    :func:`count_rules`.
    """
    parts = [
        violations.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        for name, violations in checks.items()
    ]
    parts.extend(counted)
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.withColumn("passed", F.col("violations") == 0)


def require_quality(report: DataFrame) -> None:
    """Raise if any check failed.  The report has one row per check."""
    failed = [(r["check_name"], r["violations"]) for r in report.where("not passed").collect()]
    if failed:
        detail = ", ".join(f"{name} ({count})" for name, count in sorted(failed))
        raise QualityGateError(f"Quality checks failed: {detail}")
