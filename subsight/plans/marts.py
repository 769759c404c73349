"""The mart layer: which operator feeds which table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from subsight.operators.activation import account_activation, mart_activation
from subsight.operators.activity import (
    account_activity,
    dim_account,
    dim_user,
    fact_product_events,
    fact_subscriptions,
    feature_adoption,
    mart_account_activity,
)
from subsight.operators.features import churn_features, prediction_spine
from subsight.operators.retention import logo_churn, retention_behavior, retention_cohorts, retention_segments
from subsight.operators.revenue import account_monthly_revenue, revenue_churn, revenue_retention
from subsight.operators.usage import daily_usage
from subsight.sinks.tables import write_table
from subsight.sources.events import stg_events
from subsight.sources.tables import require_models

# Output order of each model when it is read for reporting.
MODEL_ORDER = {
    "dim_account": ("account_id",),
    "fact_subscriptions": ("subscription_id",),
    "mart_activation": ("account_id",),
    "mart_feature_adoption": ("display_order",),
    "mart_account_activity": ("account_id",),
    "fact_product_events": ("event_timestamp", "event_id"),
    "mart_retention_cohorts": ("cohort_week", "weeks_since_start"),
    "mart_logo_churn": ("month",),
    "mart_revenue_churn": ("month",),
    "mart_revenue_retention": ("month",),
    "mart_retention_segments": ("segment_type", "segment_value"),
    "mart_retention_behavior": ("retention_status",),
}
REQUIRED_MODELS = tuple(MODEL_ORDER)


@dataclass(frozen=True)
class Staged:
    """The five typed tables, events deduplicated."""

    accounts: DataFrame
    users: DataFrame
    subscriptions: DataFrame
    invoices: DataFrame
    events: DataFrame


def stage(tables: Mapping[str, DataFrame], streamed: DataFrame | None = None) -> Staged:
    """Typed tables as read by ``read_tables``, plus landed stream events."""
    return Staged(
        accounts=tables["accounts"],
        users=tables["users"],
        subscriptions=tables["subscriptions"],
        invoices=tables["invoices"],
        events=stg_events(tables["events"], streamed),
    )


Store = Callable[[str, DataFrame], DataFrame]


def stored_in(spark: SparkSession, folder: str) -> Store:
    """Write each mart when it is built and go on from the written table."""

    def store(name: str, df: DataFrame) -> DataFrame:
        return spark.read.schema(df.schema).parquet(write_table(df, folder, name))

    return store


class MeasuredStore:
    """A store that counts the rows breaking each rule in the write itself.

    ``rules`` are conditions on bad rows by mart and rule name.  They are
    observed on top of the plan that is written, in its last stage, so every
    row is counted once and nothing is read again.  Counts gather in
    ``violations``, one number per rule.
    """

    def __init__(self, spark: SparkSession, folder: str, rules: Mapping[str, Mapping[str, Column]]):
        self.spark, self.folder, self.rules = spark, folder, rules
        self.violations: dict[str, int] = {}

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        measured, rules = df, self.rules.get(name)
        if rules:
            seen = Observation()
            counts = [F.count(F.when(failed, F.lit(1))).alias(rule) for rule, failed in rules.items()]
            measured = df.observe(seen, *counts)
        path = write_table(measured, self.folder, name)
        if rules:
            self.violations |= seen.get
        return self.spark.read.schema(df.schema).parquet(path)

    def counted(self) -> DataFrame:
        """The counts as :func:`subsight.operators.quality.count_rules` gives them."""
        return self.spark.createDataFrame(list(self.violations.items()), "check_name string, violations bigint")


def materialise_events(staged: Staged, folder: str, store: Store | None = None) -> tuple[Staged, DataFrame]:
    """Store deduplicated events and their daily roll-up once.

    A DataFrame is recomputed by every action.  Deduplication is the one full
    shuffle of raw events, so it is paid here and the marts start from the
    stored tables, most of them from the much smaller roll-up.
    """
    store = store or stored_in(staged.accounts.sparkSession, folder)
    events = store("fact_product_events", fact_product_events(staged.events))
    usage = store("daily_usage", daily_usage(events))
    return (
        Staged(staged.accounts, staged.users, staged.subscriptions, staged.invoices, events),
        usage,
    )


#: Marts that are written at the same time, so that one's last tasks leave no cores idle.
_AT_ONCE = 4


def build_marts(staged: Staged, usage: DataFrame | None = None, store: Store | None = None) -> dict[str, DataFrame]:
    """All marts by name.

    ``usage`` is the stored daily roll-up, if there is one.  Without a store
    the marts are lazy; with one, tables that feed others are computed once,
    and those that do not feed each other side by side.
    """
    keep = store or (lambda _, df: df)
    events = staged.events if usage is None else usage
    marts: dict[str, DataFrame] = {}

    def add(name: str, make: Callable[..., DataFrame], *args) -> DataFrame:
        return keep(name, make(*args))

    def features(activation: DataFrame) -> DataFrame:
        snapshots = prediction_spine(staged.subscriptions, staged.invoices)
        return churn_features(snapshots, staged.accounts, events, staged.invoices, activation)

    def activity() -> DataFrame:
        return mart_account_activity(account_activity(staged.accounts, staged.users, events))

    with ThreadPoolExecutor(_AT_ONCE if store else 1) as pool:

        def start(name: str, make: Callable[..., DataFrame], *args) -> None:
            running[name] = pool.submit(inheritable_thread_target(add), name, make, *args)

        running: dict[str, Future] = {}
        # what others wait for comes first, and then the largest one
        start("int_account_activation", account_activation, staged.accounts, events)
        start("dim_account", dim_account, staged.accounts, staged.subscriptions)
        start("int_account_monthly_revenue", account_monthly_revenue, staged.invoices, staged.subscriptions)
        start("mart_account_activity", activity)
        activation, dim = running["int_account_activation"].result(), running["dim_account"].result()
        start("mart_churn_features", features, activation)
        start("mart_feature_adoption", feature_adoption, staged.accounts, events)
        start("mart_retention_cohorts", retention_cohorts, staged.accounts, events)
        start("mart_logo_churn", logo_churn, staged.subscriptions, events)
        start("dim_user", dim_user, staged.users)
        start("fact_subscriptions", fact_subscriptions, staged.subscriptions)
        start("mart_activation", mart_activation, activation)
        start("mart_retention_segments", retention_segments, dim)
        revenue = running["int_account_monthly_revenue"].result()
        start("mart_revenue_churn", revenue_churn, revenue)
        start("mart_revenue_retention", revenue_retention, revenue)
        start("mart_retention_behavior", retention_behavior, dim, running["mart_account_activity"].result())
        marts.update((name, mart.result()) for name, mart in running.items())
    marts["fact_product_events"] = fact_product_events(staged.events)  # stored by materialise_events
    return marts


def load_models(marts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The reporting models in their fixed output order; fails if one is missing."""
    require_models(marts, REQUIRED_MODELS)
    return {name: marts[name].orderBy(*order) for name, order in MODEL_ORDER.items()}
