"""State of the batch tables as of a date, for dated snapshots and backfills."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsight.schemas import PRIMARY_KEYS

DATASETS = ("accounts", "subscriptions", "invoices")
_SINCE = {
    "accounts": "account_created_at",
    "subscriptions": "trial_start_date",
    "invoices": "invoice_date",
}


def parse_logical_date(value: str) -> date:
    """Strict ISO date of a run."""
    try:
        return date.fromisoformat(value) if len(value) == 10 else _reject(value)
    except (TypeError, ValueError) as error:
        raise ValueError(f"{value!r} is no calendar date of the form YYYY-MM-DD") from error


def _reject(value: str):
    raise ValueError(value)


def _as_date(name: str) -> Column:
    # raw files may hold unparseable text, which counts as no date
    return F.col(name).try_cast("date")


def _status_as_of(day: Column) -> Column:
    started, cancelled = _as_date("subscription_start_date"), _as_date("cancellation_date")
    return F.when(cancelled <= day, "cancelled").when(started <= day, "active").otherwise("trial")


def _restated(dataset: str, df: DataFrame, day: Column) -> DataFrame:
    if dataset == "subscriptions":
        return df.withColumn("subscription_status", _status_as_of(day))
    return df


def _checked(dataset: str) -> str:
    if dataset not in DATASETS:
        raise ValueError(f"no snapshots are kept of {dataset}")
    return dataset


def as_of(dataset: str, df: DataFrame, day: date | Column) -> DataFrame:
    """Rows that existed on ``day``; subscription status as it was then."""
    _checked(dataset)
    day = day if isinstance(day, Column) else F.lit(day)
    return _restated(dataset, df.where(_as_date(_SINCE[dataset]) <= day), day)


def accounts_as_of(df: DataFrame, day: date | Column) -> DataFrame:
    return as_of("accounts", df, day)


def subscriptions_as_of(df: DataFrame, day: date | Column) -> DataFrame:
    return as_of("subscriptions", df, day)


def invoices_as_of(df: DataFrame, day: date | Column) -> DataFrame:
    return as_of("invoices", df, day)


def snapshots_for_dates(dataset: str, df: DataFrame, days: Iterable[date]) -> DataFrame:
    """Snapshots of many dates from one scan, told apart by ``snapshot_date``."""
    _checked(dataset)
    wanted = F.array(*[F.lit(d) for d in sorted(set(days))])
    existed = F.filter(wanted, lambda d: d >= _as_date(_SINCE[dataset]))
    return _restated(dataset, df.withColumn("snapshot_date", F.explode(existed)), F.col("snapshot_date"))


def key_violations(dataset: str, snapshot: DataFrame) -> DataFrame:
    """Null or repeated primary keys within one snapshot date."""
    key = PRIMARY_KEYS[_checked(dataset)]
    return (
        snapshot.groupBy("snapshot_date", F.col(key).alias("key"))
        .agg(F.count("*").alias("row_count"))
        .where(F.col("key").isNull() | (F.col("row_count") > 1))
        .withColumn("problem", F.when(F.col("key").isNull(), "null").otherwise("duplicate"))
    )
