"""Reporting operators on a filtered cohort of accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight import schemas
from subsight.functions.expr import count_where, fill, one_decimal_percent_text, percent_text, ratio_or_zero
from subsight.operators.activity import feature_adoption, monthly_active_accounts
from subsight.operators.usage import as_usage

ALL = "All"


def filter_accounts(
    dim_account: DataFrame, plan: str = ALL, engagement_level: str = ALL, subscription_status: str = ALL
) -> DataFrame:
    """Accounts matching every filter; ``"All"`` means no filter."""
    wanted = {"plan": plan, "engagement_level": engagement_level, "subscription_status": subscription_status}
    selected = dim_account
    for column, value in wanted.items():
        if value != ALL:
            selected = selected.where(F.col(column) == value)
    return selected


def restrict_to_accounts(df: DataFrame, accounts: DataFrame) -> DataFrame:
    return df.join(accounts.select("account_id"), "account_id", "left_semi")


def align_activity_periods(activity: DataFrame, all_periods: DataFrame, period: str) -> DataFrame:
    """Every period of the whole data, with zero where the cohort was idle."""
    return (
        all_periods.select(period)
        .distinct()
        .join(activity, period, "left")
        .select(period, F.coalesce("active_accounts", F.lit(0).cast("bigint")).alias("active_accounts"))
    )


def kpis(
    accounts: DataFrame,
    subscriptions: DataFrame,
    activation: DataFrame,
    cohort_events: DataFrame,
    all_events: DataFrame,
) -> DataFrame:
    """Executive figures of a cohort in one row.

    Monthly active accounts are those of the latest month seen in the whole
    data, which the cohort may have missed.
    """
    total = accounts.agg(F.count("*")).scalar()
    converted = subscriptions.agg(F.count("subscription_start_date")).scalar()
    latest_day = as_usage(all_events).agg(F.max("event_date")).scalar()
    latest_month = F.trunc(latest_day, "month")
    active = (
        as_usage(cohort_events)
        .where(F.trunc("event_date", "month") == latest_month)
        .agg(F.count_distinct("account_id"))
        .scalar()
    )
    activated = count_where(F.col("is_activated"))
    base = activation.agg(
        activated.alias("activated_accounts"),
        F.median(F.when(F.col("is_activated"), F.col("days_to_activation"))).alias("median_days_to_activation"),
    )
    return base.select(
        total.alias("total_accounts"),
        "activated_accounts",
        ratio_or_zero(F.col("activated_accounts"), total).alias("activation_rate"),
        "median_days_to_activation",
        ratio_or_zero(converted, total).alias("trial_conversion_rate"),
        active.alias("monthly_active_accounts"),
        latest_month.alias("latest_observed_month"),
    )


def activation_funnel(accounts: DataFrame, activation: DataFrame, events: DataFrame) -> DataFrame:
    """Accounts per onboarding stage and their share of the cohort.

    Milestones count if they ever happened; the last stage uses the trial
    window rule.
    """
    total = accounts.agg(F.count("*")).scalar()
    activated = activation.agg(count_where(F.col("is_activated"))).scalar()
    reached = (
        as_usage(events)
        .where(F.col("event_name").isin(*[name for _, name in schemas.FUNNEL_STAGES if name]))
        .groupBy("event_name")
        .agg(F.count_distinct("account_id").alias("reached"))
    )
    stages = [(i, title, name) for i, (title, name) in enumerate(schemas.FUNNEL_STAGES, start=1)]
    spine = accounts.sparkSession.createDataFrame(stages, "stage_order int, stage string, event_name string")
    count = (
        F.when(F.col("stage_order") == 1, total)
        .when(F.col("stage_order") == len(stages), activated)
        .otherwise(F.coalesce("reached", F.lit(0).cast("bigint")))
    )
    share = ratio_or_zero(count, total)
    return spine.join(reached, "event_name", "left").select(
        "stage_order",
        "stage",
        count.alias("account_count"),
        share.alias("percentage"),
        percent_text(share).alias("percentage_display"),
    )


def cohort_feature_adoption(accounts: DataFrame, events: DataFrame, mart: DataFrame | None = None) -> DataFrame:
    """Feature adoption of a cohort; a stored mart serves the unfiltered case."""
    adoption = feature_adoption(accounts, events, zero_when_empty=True) if mart is None else mart
    rate = F.coalesce("adoption_rate", F.lit(0.0))
    return adoption.select(
        "feature_name",
        "accounts_using_feature",
        "total_accounts",
        rate.alias("adoption_rate"),
        (rate * 100).alias("adoption_percentage"),
    )


def activity_table(activity: DataFrame, accounts: DataFrame) -> DataFrame:
    """Account activity beside plan, engagement and status."""
    attributes = accounts.select("account_id", "plan", "engagement_level", "subscription_status")
    return activity.join(attributes, "account_id", "left").select(
        "account_id",
        "plan",
        "engagement_level",
        "subscription_status",
        "total_events",
        "active_users",
        "first_event_at",
        "last_event_at",
        "report_created_count",
        "report_exported_count",
        "dashboard_viewed_count",
    )


def in_activity_order(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("total_events"), F.asc("account_id"))


def rate_trend(df: DataFrame, rate: str) -> DataFrame:
    return df.select("month", rate, (F.col(rate) * 100).alias("percentage"))


def insights(kpi: DataFrame, adoption: DataFrame, monthly: DataFrame, limit: int = 4) -> DataFrame:
    """Factual sentences about a cohort, in order, at most ``limit`` of them.

    Inputs are one KPI row, the five adoption rows and one row per month; the
    month-over-month sentence compares the last two.
    """

    def rate_of(name: str):
        return adoption.where(F.col("feature_name") == name).agg(F.max("adoption_rate")).scalar()

    integration = F.coalesce(rate_of("integration_connected"), F.lit(0.0))
    report = F.coalesce(rate_of("report_created"), F.lit(0.0))
    latest_two = monthly.agg(
        F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("month_start", "active_accounts")))), 1, 2).alias("m")
    ).scalar()
    median = F.col("median_days_to_activation")
    whole = median == F.floor(median)
    median_text = F.when(whole, median.cast("bigint").cast("string")).otherwise(F.format_string("%.1f", median))
    latest, before = F.get(latest_two, F.lit(0)), F.get(latest_two, F.lit(1))
    change = latest.getField("active_accounts") - before.getField("active_accounts")
    rates = {"integration": percent_text(integration), "report": percent_text(report)}
    sentences = F.array_compact(
        F.array(
            fill(schemas.INSIGHT_ACTIVATION, percent=percent_text(F.col("activation_rate"))),
            F.when(median.isNotNull(), fill(schemas.INSIGHT_MEDIAN, days=median_text)),
            F.when(integration < report, fill(schemas.INSIGHT_LOWER, **rates)).when(
                integration > report, fill(schemas.INSIGHT_HIGHER, **rates)
            ),
            F.when(change > 0, fill(schemas.INSIGHT_UP, count=change))
            .when(change < 0, fill(schemas.INSIGHT_DOWN, count=F.abs(change)))
            .when(change == 0, schemas.INSIGHT_SAME),
        )
    )
    chosen = F.when(F.col("total_accounts") == 0, F.array(F.lit(schemas.INSIGHT_EMPTY))).otherwise(
        F.slice(sentences, 1, limit)
    )
    return kpi.select(F.posexplode(chosen).alias("position", "insight"))


def retention_insights(segments: DataFrame, retention: DataFrame) -> DataFrame:
    """Best plan, best engagement level and the latest net revenue retention."""

    def best(kind: str):
        # first of the tied values in name order
        rows = segments.where((F.col("segment_type") == kind) & F.col("retention_rate").isNotNull())
        top = rows.agg(F.max("retention_rate")).scalar()
        return rows.where(F.col("retention_rate") == top).agg(
            F.min_by(F.struct("segment_value", "retention_rate"), "segment_value").alias("b")
        )

    percent = one_decimal_percent_text(F.col("b.retention_rate"))
    plan = best("plan").select(
        F.lit(1).alias("position"),
        fill(schemas.INSIGHT_PLAN, plan=F.col("b.segment_value"), percent=percent).alias("insight"),
    )
    engagement = best("engagement_level").select(
        F.lit(2).alias("position"),
        fill(schemas.INSIGHT_ENGAGEMENT, level=F.initcap("b.segment_value"), percent=percent).alias("insight"),
    )
    latest = retention.agg(F.max_by(F.struct("nrr", "churned_mrr"), "month").alias("l")).select(
        F.lit(3).alias("position"),
        fill(
            schemas.INSIGHT_NRR,
            percent=one_decimal_percent_text(F.col("l.nrr")),
            amount=F.format_number(F.col("l.churned_mrr"), 0),
        ).alias("insight"),
    )
    return plan.unionByName(engagement).unionByName(latest).where(F.col("insight").isNotNull())


__all__ = [
    "filter_accounts",
    "restrict_to_accounts",
    "align_activity_periods",
    "kpis",
    "activation_funnel",
    "cohort_feature_adoption",
    "activity_table",
    "in_activity_order",
    "rate_trend",
    "insights",
    "retention_insights",
    "monthly_active_accounts",
]
