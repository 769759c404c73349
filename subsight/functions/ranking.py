"""Global running totals without a single-task window.

A window without ``partitionBy`` sorts everything in one task.  Here the rows
are range-partitioned over the whole order (so equal leading keys may be split
over tasks), each block is summed on its own, and the totals of the blocks,
one row per task, are turned into offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsight.session import stable

# monotonically_increasing_id keeps the partition number above this many bits
_PARTITION_SHIFT = 33


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: dict[str, str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums over ``order``, restarting at each key.

    ``totals`` maps new column names to the numeric columns they accumulate.
    The sums must be integers so that subtracting offsets is exact.  ``keys``
    is a small set of groups, such as one per model.
    """
    sorted_rows = df.orderBy(*[F.col(k) for k in keys], *order)
    tagged = stable(sorted_rows.withColumn("_row", F.monotonically_increasing_id()))
    tagged = tagged.withColumn("_block", F.shiftright("_row", _PARTITION_SHIFT))

    inside = Window.partitionBy("_block").orderBy("_row")
    local = tagged.withColumns({f"_in_{t}": F.sum(c).over(inside) for t, c in totals.items()})

    # one row per task, so this window is as small as the number of tasks
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = tagged.groupBy("_block").agg(*[F.sum(c).alias(f"_sum_{t}") for t, c in totals.items()])
    offsets = blocks.select(
        "_block",
        *[F.coalesce(F.sum(f"_sum_{t}").over(earlier), F.lit(0)).alias(f"_off_{t}") for t in totals],
    )
    summed = local.join(F.broadcast(offsets), "_block").withColumns(
        {t: F.col(f"_in_{t}") + F.col(f"_off_{t}") for t in totals}
    )
    result = summed.select(*df.columns, *totals)
    if not keys:
        return result

    # Running sums go over all keys in key order; take off what came before.
    per_key = tagged.groupBy(*keys).agg(*[F.sum(c).alias(f"_key_{t}") for t, c in totals.items()])
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_key.select(
        *keys,
        *[F.coalesce(F.sum(f"_key_{t}").over(before), F.lit(0)).alias(f"_start_{t}") for t in totals],
    )
    renamed = starts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[f"_start_{t}" for t in totals])
    matches = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    joined = result.join(renamed, matches)
    return joined.withColumns({t: F.col(t) - F.col(f"_start_{t}") for t in totals}).select(*result.columns)
