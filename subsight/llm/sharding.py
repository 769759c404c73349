"""Resharding by minimum-cost flow.

Old shards are sources with their bytes, new shards sinks with their
capacities; a byte that stays in its shard costs nothing, any other one costs
one.  The flow of least cost says how many bytes go from which old to which new
shard.  Each old shard is then cut, in a fixed order of its rows, into one
contiguous piece per target, and only files of shards that gain or lose rows
are rewritten.

The flow knows shards, never rows: its size is the number of shards.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subsight.session import stable

#: A row costs this many bytes besides its text.
ROW_BYTES = 16


def min_cost_flow(
    supply: Sequence[int], capacity: Sequence[int], cost: Sequence[Sequence[int]]
) -> list[tuple[int, int, int]]:
    """(source, sink, amount) of least total cost; integers throughout.

    Successive shortest paths with node potentials.  Supplies must fit into
    the capacities in total.
    """
    if sum(supply) > sum(capacity):
        raise ValueError("capacities are smaller than what there is to place")
    n, m = len(supply), len(capacity)
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    # nodes: sources 0..n-1, sinks n..n+m-1
    potential = [0] * n + [min((cost[i][j] for i in range(n)), default=0) for j in range(m)]
    while any(left):
        distance: list[float] = [float("inf")] * (n + m)
        parent = [-1] * (n + m)
        heap = []
        for i in range(n):
            if left[i]:
                # a virtual source reaches all that still have supply at no cost
                distance[i] = -potential[i]
                heap.append((distance[i], i))
        low = min(d for d, _ in heap)
        for i in range(n):
            if left[i]:
                distance[i] -= low
        heap = [(distance[i], i) for i in range(n) if left[i]]
        heapq.heapify(heap)
        done = [False] * (n + m)
        while heap:
            d, u = heapq.heappop(heap)
            if done[u]:
                continue
            done[u] = True
            if u < n:
                steps = ((n + j, cost[u][j]) for j in range(m))
            else:
                steps = ((i, -cost[i][u - n]) for i in range(n) if flow[i][u - n])
            for v, c in steps:
                reach = d + c + potential[u] - potential[v]
                if reach < distance[v]:
                    distance[v], parent[v] = reach, u
                    heapq.heappush(heap, (reach, v))
        target = min((n + j for j in range(m) if room[j]), key=lambda v: distance[v] + potential[v])
        for v in range(n + m):
            if distance[v] < float("inf"):
                potential[v] += distance[v]
        path, v = [target], target
        while parent[v] >= 0:
            v = parent[v]
            path.append(v)
        path.reverse()
        amount = min(left[path[0]], room[target - n])
        for u, v in zip(path, path[1:]):
            if u >= n:
                amount = min(amount, flow[v][u - n])
        for u, v in zip(path, path[1:]):
            if u < n:
                flow[u][v - n] += amount
            else:
                flow[v][u - n] -= amount
        left[path[0]] -= amount
        room[target - n] -= amount
    return [(i, j, flow[i][j]) for i in range(n) for j in range(m) if flow[i][j]]


def even_capacities(total: int, shards: int) -> list[int]:
    """Capacities that differ by one at most and add up to ``total``."""
    return [total // shards + (1 if j < total % shards else 0) for j in range(shards)]


def reshard(
    rows: DataFrame,
    shards: int,
    old: str = "old_shard",
    size: str = "size",
    order: Sequence[str] = ("doc_id",),
    capacities: Sequence[int] | None = None,
    blocks: int = 1024,
) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 in each shard) to narrow rows.

    ``old`` is an integer from 0, ``size`` a positive number of bytes.  Shard
    sizes follow ``capacities`` (equal ones by default).  A first flow moves
    pieces of the old shards; its pieces end within a row, so a second one
    evens out what that row leaves over, and moves only the smallest rows.
    Equal rows take neighbouring places.  An empty table gives no rows.
    """
    columns = [c for c in rows.columns if c not in ("shard", "slot")]
    keyed = rows.select(*columns)
    total = keyed.agg(F.sum(size)).first()[0] or 0
    capacities = list(capacities) if capacities is not None else even_capacities(total, shards)
    spread = F.pmod(F.xxhash64(*order), F.lit(blocks))
    first = _place(keyed, old, size, order, capacities, spread).select(*columns, F.col("_to").alias("_mid"))
    # small rows last: those are the ones that leave
    classes = F.floor(F.log2(F.col(size).cast("double")) * 4)
    descending = (F.lit(1000) - classes) * 64 + F.pmod(F.xxhash64(*order), F.lit(64))
    placed = _place(first, "_mid", size, order, capacities, descending)

    # as many rows as there are pieces, at most twice the shards
    parts = placed.groupBy("_mid", "_to").agg(F.min("_nth").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_to").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_mid", "_to", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    slot = (F.col("_base") + F.col("_nth") - F.col("_first")).cast("bigint").alias("slot")
    return placed.join(F.broadcast(parts), ["_mid", "_to"]).select(*columns, F.col("_to").alias("shard"), slot)


def _place(
    rows: DataFrame, old: str, size: str, order: Sequence[str], capacities: Sequence[int], block: Column
) -> DataFrame:
    """Add the target ``_to`` and the place ``_nth`` of each row in its old shard.

    Running totals are formed inside blocks, and over the totals of blocks, so
    that an old shard with most of the rows is still spread out.
    """
    rows = stable(rows.withColumn("_block", block))
    columns = [c for c in rows.columns if c != "_block"]
    sums = rows.groupBy(old, "_block").agg(F.sum(size).alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(old).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = stable(
        sums.select(
            old,
            "_block",
            F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_from"),
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
            "_bytes",
        )
    )
    # one row per old shard
    held = {r[0]: r[1] for r in sums.groupBy(old).agg(F.sum("_bytes")).collect()}
    pieces = transfer_pieces(held, capacities)

    inside = Window.partitionBy(old, "_block").orderBy(*order, size)
    placed = rows.withColumns(
        {
            "_end": F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
            "_row": F.row_number().over(inside) - 1,
        }
    ).join(sums.drop("_bytes"), [old, "_block"])
    # a row belongs to the piece that holds its middle
    middle = F.col("_from") + F.col("_end") - F.floor(F.col(size) / 2)
    return stable(
        placed.select(
            *columns, (F.col("_row") + F.col("_before")).alias("_nth"), _piece_of(F.col(old), middle, pieces).alias("_to")
        )
    )


def transfer_pieces(held: dict[int, int], capacities: Sequence[int]) -> dict[int, list[tuple[int, int]]]:
    """By old shard: (end of the piece in its bytes, new shard), what stays first."""
    olds = sorted(held)
    cost = [[0 if i == j else 1 for j in range(len(capacities))] for i in olds]
    found: dict[int, list[tuple[int, int]]] = {i: [] for i in olds}
    moves = min_cost_flow([held[i] for i in olds], capacities, cost)
    for i, j, amount in sorted(moves, key=lambda x: (x[0], olds[x[0]] != x[1], x[1])):
        parts = found[olds[i]]
        parts.append(((parts[-1][0] if parts else 0) + amount, j))
    return found


def _piece_of(old: Column, at: Column, pieces: dict[int, list[tuple[int, int]]]) -> Column:
    chosen = F.lit(None).cast("int")
    for shard, parts in pieces.items():
        target = F.lit(parts[-1][1] if parts else 0)
        for end, new in reversed(parts[:-1]):
            target = F.when(at < end, F.lit(new)).otherwise(target)
        chosen = F.when(old == shard, target).otherwise(chosen)
    return chosen.cast("int")


def rewrite_affected(
    spark: SparkSession, root: str, plan: DataFrame, out: str, id_column: str = "doc_id", text: str = "text"
) -> list[int]:
    """Write the shards that change to ``out``, as ``shard=N`` folders.

    ``root`` holds the old files in ``shard=N`` folders; ``plan`` has the id,
    ``old_shard``, the new ``shard`` and, if it has one, ``text_crc32``.
    Returns the rewritten shards; files of all others in ``root`` stay valid
    and are not read.  Rows that share id, CRC of the text and old shard are
    interchangeable: the first of them takes the first place planned for one,
    and so on, so every shard gets as many rows as planned, also of rows
    without an id.  Other columns stay, whatever they are called.
    """
    moved = plan.where("old_shard <> shard")
    affected = sorted(
        r[0] for r in moved.select(F.explode(F.array("old_shard", "shard")).alias("s")).distinct().collect()
    )
    rows = spark.read.parquet(root).where(F.col("shard").isin(affected))
    kept = [c for c in rows.columns if c != "shard"]
    given = {"i": F.col(f"`{id_column}`"), "old": F.col("shard")}
    planned = {"i": F.col(f"`{id_column}`"), "old": F.col("old_shard")}
    if "text_crc32" in plan.columns:
        given["crc"] = F.crc32(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary"))
        planned["crc"] = F.col("text_crc32")
    alike = Window.partitionBy(*given)
    # the columns of a row as one, so that no name can clash
    held = rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), *[c.alias(n) for n, c in given.items()])
    held = held.withColumn("nth", F.row_number().over(alike.orderBy(F.hash("row"))))
    target = plan.where(F.col("old_shard").isin(affected)).select(*[c.alias(n) for n, c in planned.items()], F.col("shard").alias("new"))
    target = target.withColumn("nth", F.row_number().over(alike.orderBy("new")))
    same = [held[c].eqNullSafe(target[c]) for c in (*given, "nth")]
    placed = held.join(target, same).select("row.*", F.col("new").cast("int").alias("shard"))
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(out)
    return affected


#: Old shards of the documents: a hash of the source, so a hot source fills one.
OLD_SHARDS = 32


def sharded_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """All documents in ``shards`` shards of nearly equal bytes.

    NULL text has no bytes but its row; NULL source counts as an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")), F.lit(OLD_SHARDS))
        .cast("int")
        .alias("old_shard"),
    )
    placed = reshard(rows, shards, order=("doc_id", "text_crc32"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )
