"""Typed scans of the five batch tables and checks that inputs exist."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsight import schemas


class MissingInputs(FileNotFoundError):
    """Raised once, naming every input that is absent."""


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``, casting ISO strings where needed."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stg_accounts(df: DataFrame) -> DataFrame:
    return typed(df, schemas.ACCOUNTS)


def stg_users(df: DataFrame) -> DataFrame:
    return typed(df, schemas.USERS)


def stg_subscriptions(df: DataFrame) -> DataFrame:
    return typed(df, schemas.SUBSCRIPTIONS)


def stg_invoices(df: DataFrame) -> DataFrame:
    return typed(df, schemas.INVOICES)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    matches = fs.globStatus(target)
    return matches is not None and len(matches) > 0


def require_inputs(spark: SparkSession, paths: Mapping[str, str] | Iterable[str]) -> None:
    """Fail before any job starts, listing all missing inputs at once."""
    named = dict(paths) if isinstance(paths, Mapping) else {p: p for p in paths}
    missing = sorted(name for name, path in named.items() if not _exists(spark, path))
    if missing:
        raise MissingInputs("Missing inputs: " + ", ".join(missing))


def require_models(available: Iterable[str], required: Iterable[str]) -> None:
    missing = sorted(set(required) - set(available))
    if missing:
        raise MissingInputs("Required models are missing: " + ", ".join(missing))


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All five tables from ``folder/<name>.parquet``, typed, events undeduplicated."""
    paths = {name: f"{folder}/{name}.parquet" for name in schemas.TABLES}
    require_inputs(spark, paths)
    return {name: typed(spark.read.parquet(path), schemas.TABLES[name]) for name, path in paths.items()}
