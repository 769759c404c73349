"""Connected components of large sparse graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight.session import stable


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    Alternating large-star and small-star steps on the edge list: every step
    is one grouped minimum and one join, so no node's neighbours are gathered,
    and paths shrink to stars in about log(n) rounds.  Each round is
    checkpointed.  NULL ends and loops are ignored; without edges the result
    has no rows.
    """
    a, b = F.col(f"`{left}`").cast("bigint"), F.col(f"`{right}`").cast("bigint")
    current = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        a.isNotNull() & b.isNotNull() & (a != b)
    )
    current = stable(current.distinct())
    seen = _summary(current)
    while seen[0]:
        current = stable(_small_star(_large_star(current)))
        now = _summary(current)
        if now == seen:
            break
        seen = now
    lone = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(lone.distinct())


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to its smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    smaller = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(smaller).distinct()
