import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from subsight.llm.sharding import min_cost_flow, reshard, rewrite_affected, sharded_documents, transfer_pieces


def test_flow_has_the_least_cost():
    draw = random.Random(2)
    for _ in range(150):
        n, m = draw.randint(1, 3), draw.randint(1, 3)
        supply, room = [draw.randint(0, 3) for _ in range(n)], [draw.randint(0, 3) for _ in range(m)]
        if sum(room) < sum(supply):
            with pytest.raises(ValueError):
                min_cost_flow(supply, room, [[0] * m] * n)
            continue
        cost = [[draw.randint(0, 5) for _ in range(m)] for _ in range(n)]
        got = min_cost_flow(supply, room, cost)
        assert [sum(a for i, _, a in got if i == k) for k in range(n)] == supply
        assert all(sum(a for _, j, a in got if j == k) <= room[k] for k in range(m))
        units = [i for i in range(n) for _ in range(supply[i])]
        best = min(
            sum(cost[u][p] for u, p in zip(units, pick))
            for pick in itertools.product(range(m), repeat=len(units))
            if all(pick.count(j) <= room[j] for j in range(m))
        )
        assert best == sum(cost[i][j] * a for i, j, a in got)


def test_only_the_surplus_moves():
    held = {0: 90, 1: 10, 5: 20}
    pieces = transfer_pieces(held, [30, 30, 30, 30])
    assert pieces[1][0] == (10, 1) and pieces[0][0] == (30, 0)
    moved = sum(end - (parts[i - 1][0] if i else 0) for o, parts in pieces.items() for i, (end, new) in enumerate(parts) if new != o)
    assert moved == 60 + 20


def test_documents(documents):
    draw = random.Random(5)
    texts = [None, "", "é" * 7] + ["x" * draw.randint(1, 400) for _ in range(600)] + ["y" * 9000]
    rows = [*enumerate(texts), (None, "q"), (4, texts[4]), (4, texts[4])]
    out = sharded_documents(documents(rows, ("shard", "slot", "_block")), shards=7).collect()
    assert len(out) == len(rows)
    size = {s: sum(r["size"] for r in out if r.shard == s) for s in range(7)}
    assert max(size.values()) - min(size.values()) < 300
    for s in range(7):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    for r in out:
        text = "q" if r.doc_id is None else texts[r.doc_id] or ""
        assert r["size"] == len(text.encode()) + 16 and r.text_crc32 == zlib.crc32(text.encode())
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}


def test_empty_and_equal_rows(spark, documents):
    assert sharded_documents(documents([])).count() == 0
    rows = spark.createDataFrame([(1, 10, 0)] * 40, "doc_id bigint, size bigint, old_shard int")
    assert sorted(r["count"] for r in reshard(rows, 4).groupBy("shard").count().collect()) == [10] * 4


def test_hot_shard_and_given_capacities(spark):
    rows = spark.range(3000).selectExpr("id doc_id", "cast(100 as bigint) size", "cast(if(id % 3 = 0, id % 6, 1) as int) old_shard")
    out = reshard(rows, 3, capacities=[200_000, 50_000, 50_000])
    assert {r.shard: r["count"] for r in out.groupBy("shard").count().collect()} == {0: 2000, 1: 500, 2: 500}


def test_only_changed_shards_are_rewritten(spark, tmp_path):
    rows = spark.range(400).selectExpr("id doc_id", "repeat('z', 84) text", "cast(if(id < 100, 0, if(id < 200, 1, 2)) as int) shard")
    rows.write.partitionBy("shard").parquet(str(tmp_path / "old"))
    plan = reshard(rows.selectExpr("doc_id", "cast(100 as bigint) size", "shard old_shard"), 4, capacities=[10_000] * 4)
    changed = rewrite_affected(spark, str(tmp_path / "old"), plan, str(tmp_path / "new"))
    assert changed == [2, 3]
    new = spark.read.parquet(str(tmp_path / "new"))
    want = {(r.doc_id, r.shard) for r in plan.collect() if r.shard in changed}
    assert {(r.doc_id, r.shard) for r in new.collect()} == want and new.count() == 200


def test_rows_without_id_go_where_they_are_planned(spark, documents, tmp_path):
    texts = ["q" * (i % 7 + 1) for i in range(300)]
    rows = documents([(None if i % 3 else i % 5, t) for i, t in enumerate(texts)], ("_id", "_new", "row", "nth", "old"))
    old = rows.withColumn("shard", (F.length("text") % 3).cast("int"))
    old.write.partitionBy("shard").parquet(str(tmp_path / "old"))
    sized = old.selectExpr("doc_id", "cast(length(text) + 100 as bigint) size", "crc32(cast(text as binary)) text_crc32", "shard old_shard")
    plan = reshard(sized, 5)
    changed = rewrite_affected(spark, str(tmp_path / "old"), plan, str(tmp_path / "new"))
    new = spark.read.parquet(str(tmp_path / "new"))
    assert sorted(new.columns) == sorted(old.columns)

    def counts(df, *keys):
        return {tuple(r)[:-1]: r["count"] for r in df.groupBy(*keys).count().collect()}

    planned = counts(plan.where(F.col("shard").isin(changed)), "shard", "doc_id", "text_crc32")
    assert counts(new, "shard", "doc_id", F.crc32(F.col("text").cast("binary"))) == planned
