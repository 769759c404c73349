"""The daily run: snapshots, marts, quality gate, scores."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsight import schemas
from subsight.operators import quality as q
from subsight.operators.features import current_scoring_features, leakage_check
from subsight.operators.retention import SEGMENT_TYPES
from subsight.operators.scoring import score_frame
from subsight.operators.snapshots import DATASETS, parse_logical_date
from subsight.plans.marts import MeasuredStore, Staged, build_marts, materialise_events
from subsight.sinks.tables import write_scores, write_snapshot

Scorer = Callable[[DataFrame], DataFrame]


_ENUMS = {
    ("accounts", "plan"): schemas.PLANS,
    ("accounts", "engagement_level"): schemas.ENGAGEMENT_LEVELS,
    ("users", "role"): schemas.ROLES,
    ("subscriptions", "plan"): schemas.PLANS,
    ("subscriptions", "subscription_status"): schemas.SUBSCRIPTION_STATUSES,
    ("invoices", "plan"): schemas.PLANS,
    ("invoices", "payment_status"): schemas.PAYMENT_STATUSES,
    ("events", "event_name"): schemas.EVENT_NAMES,
    ("events", "event_version"): schemas.EVENT_VERSIONS,
}
_OPTIONAL = ("subscription_start_date", "cancellation_date")

MART_ENUMS = {
    ("dim_account", "plan"): schemas.PLANS,
    ("dim_account", "subscription_status"): schemas.SUBSCRIPTION_STATUSES,
    ("fact_subscriptions", "subscription_status"): schemas.SUBSCRIPTION_STATUSES,
    ("mart_feature_adoption", "feature_name"): schemas.ADOPTION_FEATURES,
    ("mart_retention_segments", "segment_type"): SEGMENT_TYPES,
    ("mart_retention_behavior", "retention_status"): ("retained", "churned"),
    ("mart_churn_features", "churn_label"): (0, 1),
}
MART_REQUIRED = {
    "dim_account": ("account_id",),
    "fact_product_events": ("event_id",),
    "fact_subscriptions": ("subscription_id",),
    "int_account_monthly_revenue": ("account_id", "month", "monthly_revenue"),
    "mart_activation": ("account_id", "is_activated"),
    "mart_account_activity": ("account_id", "seat_utilization", "events_last_7d", "events_last_30d"),
    "mart_feature_adoption": ("feature_name", "adoption_rate"),
    "mart_logo_churn": ("month",),
    "mart_revenue_churn": ("month",),
    "mart_revenue_retention": ("month",),
    "mart_retention_behavior": ("retention_status",),
    "mart_retention_segments": ("segment_type",),
    "mart_churn_features": ("account_id", "churn_label"),
}


def _rules(name: str, required: Iterable[str], enums: Mapping[tuple[str, str], Iterable]) -> dict[str, Column]:
    rules = {f"not_null_{name}_{c}": F.col(c).isNull() for c in required}
    for (table, column), values in enums.items():
        if table == name:
            rules[f"accepted_{name}_{column}"] = ~F.col(column).isin(*values)
    return rules


def mart_rules() -> dict[str, dict[str, Column]]:
    """Bad rows of each mart: missing columns and values outside the lists.

    Events are stored like a mart, so the rules of their source table are
    among those of ``fact_product_events``.
    """
    rules = {name: _rules(name, required, MART_ENUMS) for name, required in MART_REQUIRED.items()}
    rules["fact_product_events"] |= _rules("events", schemas.EVENTS.fieldNames(), _ENUMS)
    return rules


def staging_rules(staged: Staged) -> list[DataFrame]:
    """Required columns and enums of the source tables other than events, one scan per table."""
    counted = []
    for name in schemas.TABLES:
        if name != "events":
            df = getattr(staged, name)
            counted.append(q.count_rules(df, _rules(name, [c for c in df.columns if c not in _OPTIONAL], _ENUMS)))
    return counted


def staging_checks(staged: Staged, usage: DataFrame) -> dict[str, DataFrame]:
    """Keys and relationships of the source tables.

    Events are related to accounts and users by their daily roll-up; their
    key is the one they have just been deduplicated by.
    """
    pairs = usage.select("account_id", "user_id").distinct()
    checks: dict[str, DataFrame] = {}
    for name, key in schemas.PRIMARY_KEYS.items():
        df = pairs if name == "events" else getattr(staged, name)
        if name != "events":
            checks[f"unique_{name}_{key}"] = q.unique(df.select(key), key)
        if name != "accounts":
            checks[f"relationship_{name}_account"] = q.relationships(df.select("account_id"), staged.accounts, "account_id")
    checks["relationship_events_user"] = q.relationships(pairs.select("user_id"), staged.users, "user_id")
    checks["relationship_invoices_subscription"] = q.relationships(
        staged.invoices.select("subscription_id"), staged.subscriptions, "subscription_id"
    )
    return checks


def mart_checks(marts: Mapping[str, DataFrame], accounts: DataFrame, subscriptions: DataFrame) -> dict[str, DataFrame]:
    """Keys and bounds of the marts."""
    single_keys = {
        "dim_account": "account_id",
        "fact_product_events": "event_id",
        "fact_subscriptions": "subscription_id",
        "mart_activation": "account_id",
        "mart_account_activity": "account_id",
        "mart_feature_adoption": "feature_name",
        "mart_logo_churn": "month",
        "mart_revenue_churn": "month",
        "mart_revenue_retention": "month",
        "mart_retention_behavior": "retention_status",
    }
    checks = {f"unique_{mart}": q.unique(marts[mart], key) for mart, key in single_keys.items()}
    checks["unique_int_account_monthly_revenue"] = q.unique(
        marts["int_account_monthly_revenue"], "account_id", "month", "subscription_status"
    )
    checks["features_without_leakage"] = leakage_check(marts["mart_churn_features"], subscriptions)
    for mart in ("mart_activation", "mart_account_activity", "mart_churn_features"):
        checks[f"relationship_{mart}"] = q.relationships(marts[mart], accounts, "account_id")
    checks["activity_bounds"] = q.activity_bounds(marts["mart_account_activity"])
    checks["activation_consistency"] = q.activation_consistency(marts["int_account_activation"])
    checks["adoption_bounds"] = q.adoption_bounds(marts["mart_feature_adoption"])
    checks["retention_bounds"] = q.retention_bounds(marts["mart_retention_cohorts"], marts["mart_logo_churn"])
    checks["revenue_bounds"] = q.revenue_bounds(marts["mart_revenue_churn"], marts["mart_revenue_retention"])
    checks["churn_matches_cancellations"] = q.churn_matches_cancellations(marts["mart_logo_churn"], subscriptions)
    checks["churn_feature_validity"] = q.churn_feature_validity(marts["mart_churn_features"])
    return checks


def run_daily(
    day: str | date,
    staged: Staged,
    root: str,
    scorer: Scorer,
    extra_checks: Mapping[str, DataFrame] | None = None,
    score_as_of: date | None = None,
) -> DataFrame:
    """Run one day; returns the quality report.  A failed check stops scoring.

    Rules on single rows of marts are counted by the writes that store them.
    ``scorer`` turns feature rows into the same rows with
    ``churn_probability``.  Scores are as of the latest event date unless
    ``score_as_of`` is given.
    """
    logical = day if isinstance(day, date) else parse_logical_date(day)
    for dataset in DATASETS:
        write_snapshot(dataset, getattr(staged, dataset), logical, f"{root}/snapshots")

    spark = staged.accounts.sparkSession
    store = MeasuredStore(spark, f"{root}/marts", mart_rules())
    stored, usage = materialise_events(staged, f"{root}/marts", store)
    marts = build_marts(stored, usage, store)

    checks = staging_checks(stored, usage) | mart_checks(marts, stored.accounts, stored.subscriptions)
    report = q.quality_report(checks | dict(extra_checks or {}), [*staging_rules(stored), store.counted()])
    report.write.mode("overwrite").parquet(f"{root}/quality/date={logical.isoformat()}")
    report = spark.read.parquet(f"{root}/quality/date={logical.isoformat()}")
    q.require_quality(report)

    features = current_scoring_features(
        marts["dim_account"],
        usage,
        stored.invoices,
        marts["int_account_activation"],
        score_as_of,
    )
    write_scores(score_frame(scorer(features)), f"{root}/scores")
    return report
