"""Column expressions shared by the operators.  All run inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from subsight import schemas


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; NULL when the denominator is zero or NULL."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def month_start(value: Column) -> Column:
    return F.trunc(value.cast("date"), "month")


def week_start(value: Column) -> Column:
    """Monday of the week."""
    return F.trunc(value.cast("date"), "week")


def months_between_inclusive(first: Column, last: Column) -> Column:
    """Array of month starts from ``first`` to ``last``; NULL when empty.

    ``sequence`` raises if the bounds are reversed, hence the guard.  Explode
    of NULL yields no row, which is what an empty range means.
    """
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))


def weeks_between_inclusive(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 week")))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_where(condition: Column, value: Column) -> Column:
    """Sum of ``value`` over matching rows, zero when there are none."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0).cast("bigint"))


def latest_by(value: Column, *order: Column) -> Column:
    """Value of the row that sorts last, ignoring rows whose value is NULL.

    Written as the maximum of (order, value) so that it merges: partial
    results can be combined again by taking the maximum.
    """
    present = value.isNotNull() & order[0].isNotNull()
    return F.max(F.when(present, latest_struct(value, *order)))


def latest_struct(value: Column, *order: Column) -> Column:
    keys = [key.alias(f"k{i}") for i, key in enumerate(order)]
    return F.struct(*keys, value.alias("value"))


def percent_text(value: Column) -> Column:
    """Whole percent with half-to-even rounding, e.g. 0.125 gives ``12%``."""
    return F.concat(F.bround(value * 100, 0).cast("bigint").cast("string"), F.lit("%"))


def one_decimal_text(value: Column) -> Column:
    """One decimal of a double, rounded by its exact binary value, ties to even.

    Twenty times the value is compared with the odd number between two
    results.  Its product is formed from two halves of the mantissa, so that
    nothing is lost and the sign of the difference is exact.
    """
    size = F.abs(value.cast("double"))
    low = F.floor(size * 10).cast("bigint")
    head = size.cast("float").cast("double")
    over = (head * 20 - (low * 2 + 1)) + (size - head) * 20
    tenths = low + F.when((over > 0) | ((over == 0) & (low % 2 == 1)), 1).otherwise(0)
    sign = F.when(value < 0, "-").otherwise("")
    return F.concat(sign, F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def one_decimal_percent_text(value: Column) -> Column:
    return F.concat(one_decimal_text(value * 100), F.lit("%"))


def plural(count: Column, singular: str) -> Column:
    """``1 failed payment`` / ``2 failed payments``."""
    return F.concat(
        count.cast("string"),
        F.lit(f" {singular}"),
        F.when(count == 1, "").otherwise("s"),
    )


def fill(template: str, **values: Column) -> Column:
    """Text with ``{name}`` placeholders replaced by columns; NULL if one is NULL."""
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [values[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(parts) if i % 2 or p]
    return F.concat(*pieces)


def freshness_text(seconds: Column) -> Column:
    """Age in words: seconds, whole minutes, then hours with one decimal."""
    minutes = F.floor(seconds / 60).cast("bigint")
    return (
        F.when(seconds.isNull(), schemas.FRESHNESS_EMPTY)
        .when(seconds < 60, fill(schemas.FRESHNESS_SECONDS, n=F.floor(seconds).cast("bigint")))
        .when(seconds < 120, fill(schemas.FRESHNESS_MINUTE, n=minutes))
        .when(seconds < 3600, fill(schemas.FRESHNESS_MINUTES, n=minutes))
        .otherwise(fill(schemas.FRESHNESS_HOURS, n=one_decimal_text(seconds / 3600)))
    )


def health_status(seconds: Column, limit_seconds: int = schemas.HEALTHY_SECONDS) -> Column:
    return (
        F.when(seconds.isNull(), schemas.STREAM_EMPTY)
        .when(seconds <= limit_seconds, schemas.STREAM_HEALTHY)
        .otherwise(schemas.STREAM_STALE)
    )


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))
