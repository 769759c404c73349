"""Registration of queries with their check SQL.

A query is a function of :class:`fixture_views.TestData`.  Its SQL, if any, is
written against the views of ``duckdb_ctes`` and states the result from the
definition, without the plan shapes the operators use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixture_views import TestData, duckdb_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Zone-free timestamps (UTC) and joined lists, comparable across engines."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz").alias(field.name)
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, " | ").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register a query; ``ctes`` are further views, placed before ``sql``."""

    def register(build: Callable[[TestData], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(TestData(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = duckdb_ctes() + (",\n" + ctes if ctes else "") + "\n" + sql
        return build

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    """Round averages, whose last digits depend on the order of addition."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})
