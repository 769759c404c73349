"""Risk buckets, readable reasons and ranked answers over scored accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsight import schemas
from subsight.functions.expr import blank_to_null, fill, percent_text, plural
from subsight.schemas import HIGH_RISK, MEDIUM_RISK, RISK_BUCKETS, SCORE_COLUMNS

MAX_LISTED = 100


def risk_bucket(probability: Column, high: float = HIGH_RISK, medium: float = MEDIUM_RISK) -> Column:
    return F.when(probability >= high, "High").when(probability >= medium, "Medium").otherwise("Low")


def risk_reasons(limit: int = 3) -> Column:
    """Up to ``limit`` descriptive signals of one feature row, in fixed order.

    A NULL feature never raises a signal.
    """
    change, seats = F.col("event_change_pct"), F.col("seat_utilization")
    idle, report_age = F.col("days_since_last_activity"), F.col("days_since_last_report")
    failed = F.col("failed_payments_last_90d")

    signals = F.array(
        F.when(change <= -0.30, fill(schemas.REASON_DECLINE, percent=percent_text(F.abs(change)))),
        F.when(seats < 0.25, fill(schemas.REASON_SEATS, percent=percent_text(seats))),
        F.when(idle >= 14, fill(schemas.REASON_IDLE, days=idle)),
        F.when(
            F.col("reports_created_last_30d") == 0,
            F.coalesce(fill(schemas.REASON_OLD_REPORT, days=report_age), F.lit(schemas.REASON_NO_REPORT)),
        ),
        F.when(failed > 0, fill(schemas.REASON_PAYMENTS, payments=plural(failed, "failed payment"))),
        F.when(F.col("integrations_connected") == 0, F.lit(schemas.REASON_INTEGRATION)),
        F.when(F.col("active_users_last_30d") <= 1, F.lit(schemas.REASON_USERS)),
    )
    found = F.array_compact(signals)
    default = F.array(F.lit(schemas.REASON_DEFAULT))
    return F.when(F.size(found) > 0, F.slice(found, 1, limit)).otherwise(default)


def with_reasons(features: DataFrame) -> DataFrame:
    reasons = features.withColumn("_reasons", risk_reasons())
    return reasons.withColumns(
        {f"top_reason_{i}": F.try_element_at(F.col("_reasons"), F.lit(i)) for i in (1, 2, 3)}
    ).drop("_reasons")


def score_frame(scored_features: DataFrame, high: float = HIGH_RISK, medium: float = MEDIUM_RISK) -> DataFrame:
    """Score table from feature rows that already carry ``churn_probability``."""
    return (
        with_reasons(scored_features)
        .withColumn("risk_bucket", risk_bucket(F.col("churn_probability"), high, medium))
        .withColumn("monthly_revenue", F.col("monthly_revenue").cast("double"))
        .select(*SCORE_COLUMNS)
    )


def score_accounts(model, features: DataFrame, high: float = HIGH_RISK, medium: float = MEDIUM_RISK) -> DataFrame:
    """Apply a fitted model and attach bucket, reasons and revenue."""
    from subsight.operators.models import predict

    return score_frame(predict(model, features), high, medium)


def in_rank_order(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.desc("churn_probability"), F.desc("monthly_revenue"), F.asc("account_id"))


def _reasons_array() -> Column:
    return F.array_compact(F.array(*[blank_to_null(F.col(f"top_reason_{i}")) for i in (1, 2, 3)]))


def rank_accounts(scores: DataFrame, bucket: str | None = None, limit: int = 20, tie: str = "revenue") -> DataFrame:
    """Highest risk first; ties by revenue, or by account id with ``tie="account"``.

    The limit is small by contract, so this is a bounded top-k, not a full sort.
    """
    if not 1 <= limit <= MAX_LISTED:
        raise ValueError(f"limit must be between 1 and {MAX_LISTED}")
    if bucket is not None and bucket not in RISK_BUCKETS:
        raise ValueError(f"unknown risk bucket: {bucket}")
    selected = scores if bucket is None else scores.where(F.col("risk_bucket") == bucket)
    ties = [F.asc("account_id")] if tie == "account" else [F.desc("monthly_revenue"), F.asc("account_id")]
    return (
        selected.orderBy(F.desc("churn_probability"), *ties)
        .limit(limit)
        .select(
            "account_id",
            F.col("churn_probability").alias("churn_score"),
            "risk_bucket",
            "prediction_date",
            "monthly_revenue",
            _reasons_array().alias("top_reasons"),
        )
    )


def account_risk(scores: DataFrame, account_id: str) -> DataFrame:
    """The answer for one account; the id is trimmed and upper-cased."""
    return scores.where(F.col("account_id") == account_id.strip().upper()).select(
        "account_id",
        F.col("churn_probability").alias("churn_score"),
        "risk_bucket",
        "prediction_date",
        "monthly_revenue",
        _reasons_array().alias("top_reasons"),
    )


def risk_summary(scores: DataFrame) -> DataFrame:
    def in_bucket(name: str) -> Column:
        return F.count(F.when(F.lower("risk_bucket") == name, F.lit(1)))

    return scores.agg(
        F.count("*").alias("scored_accounts"),
        in_bucket("high").alias("high_risk_accounts"),
        in_bucket("medium").alias("medium_risk_accounts"),
        in_bucket("low").alias("low_risk_accounts"),
        F.coalesce(F.sum(F.when(F.lower("risk_bucket") == "high", F.col("monthly_revenue"))), F.lit(0.0)).alias(
            "high_risk_monthly_revenue"
        ),
    )


def validate_scores(scores: DataFrame) -> DataFrame:
    """One row per broken rule of the score table, with the number of rows."""
    missing = sorted(set(SCORE_COLUMNS) - set(scores.columns))
    if missing:
        raise ValueError("Score table is missing columns: " + ", ".join(missing))
    p = F.col("churn_probability")
    bad_bucket = ~F.coalesce(F.col("risk_bucket").isin(*RISK_BUCKETS), F.lit(False))
    counted = scores.agg(
        F.when(F.count("*") == 0, 1).otherwise(0).cast("bigint").alias("empty"),
        F.count(F.when(~F.coalesce((p >= 0) & (p <= 1), F.lit(False)), F.lit(1))).alias("probability_range"),
        F.count(F.when(bad_bucket, F.lit(1))).alias("risk_bucket"),
    )
    duplicates = (
        scores.groupBy("account_id").count().where("count > 1").agg(F.count("*").alias("duplicate_account")).scalar()
    )
    rules = ("empty", "probability_range", "risk_bucket", "duplicate_account")
    return (
        counted.withColumn("duplicate_account", duplicates)
        .select(F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("violations")) for r in rules])).alias("r"))
        .select("r.rule", "r.violations")
        .where("violations > 0")
    )
