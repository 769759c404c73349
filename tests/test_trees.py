import pickle

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from subsight.operators import trees as tr


def plain_trees(x, y, w, rounds, most_leaves, least_rows, step):
    """Best-first boosting by sorting rows at every node, for exact small tables."""
    score, out = np.zeros(len(y)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = np.rint(w * (p - y) * 2**20), np.rint(w * p * (1 - p) * 2**20)

        def split(rows):
            best = None
            whole = g[rows].sum() ** 2 / max(h[rows].sum(), 1e-3 * 2**20)
            for f in range(x.shape[1]):
                for cut in sorted(set(x[:, f])):
                    left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if min(len(left), len(right)) < least_rows or min(h[left].sum(), h[right].sum()) < 1e-3 * 2**20:
                        continue
                    gain = g[left].sum() ** 2 / h[left].sum() + g[right].sum() ** 2 / h[right].sum() - whole
                    if gain > 1.0 and (best is None or gain > best[0] * (1 + 1e-12)):
                        best = (gain, f, cut, left, right)
            return best

        leaves = [np.arange(len(y))]
        splits = [split(leaves[0])]
        while len(leaves) < most_leaves and any(splits):
            at = max((i for i, s in enumerate(splits) if s), key=lambda i: splits[i][0])
            _, _, _, left, right = splits[at]
            leaves[at : at + 1] = [left, right]
            splits[at : at + 1] = [split(left), split(right)]
        for rows in leaves:
            score[rows] -= step * g[rows].sum() / h[rows].sum()
        out.append(sorted(len(r) for r in leaves))
    return score, out


@pytest.fixture(scope="module")
def table():
    chance = np.random.default_rng(3)
    x = np.column_stack([chance.integers(0, 12, 300), np.round(chance.normal(size=300), 1), chance.integers(0, 3, 300)]).astype(float)
    y = ((x[:, 0] > 6) ^ (x[:, 1] > 0.3) ^ (chance.random(300) < 0.15)).astype(float)
    return x, y, np.where(y == 1, 1.5, 0.75)


def frame(spark, table, parts):
    x, y, w = table
    rows = [(r.tolist(), float(b), float(c)) for r, b, c in zip(x, y, w)]
    df = spark.createDataFrame(rows, "x array<double>, label double, weight double").repartition(parts)
    return df.withColumn("features", array_to_vector("x"))


def test_equals_a_plain_grower(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(tr, "_TASK_ROWS", 100)
    x, y, w = table
    df = frame(spark, table, 3)
    model = tr.BestFirstBoosting(weightCol="weight", maxIter=12, stepSize=0.3, maxLeaves=6, minRows=8).fit(df)
    score, sizes = plain_trees(x, y, w, 12, 6, 8, 0.3)
    found = {tuple(r.x): r.p for r in model.transform(df).select("x", tr.vector_to_array("probability")[1].alias("p")).collect()}
    for row, s in zip(x, score):
        assert found[tuple(row)] == pytest.approx(1 / (1 + np.exp(-s)), abs=1e-9)
    leaves = {}
    for r in model.leaf_rows(df).collect():
        leaves.setdefault(r.tree, []).append(r.row_count)
    assert [sorted(leaves[t]) for t in range(12)] == sizes
    # neither the dealing of rows nor storing changes the trees
    again = tr.BestFirstBoosting(weightCol="weight", maxIter=12, stepSize=0.3, maxLeaves=6, minRows=8).fit(frame(spark, table, 5))
    assert again.getOrDefault(again.trees) == model.getOrDefault(model.trees)
    model.write().save(str(tmp_path / "model"))
    loaded = tr.BestFirstModel.load(str(tmp_path / "model"))
    assert loaded.getOrDefault(loaded.trees) == model.getOrDefault(model.trees)


def test_best_first_goes_deep_where_it_pays(spark):
    """A chain of splits: level by level it would need 2**6 leaves."""
    rows = [([float(i)], float((i // 10) % 2)) for i in range(80)]
    df = spark.createDataFrame(rows, "x array<double>, label double").withColumn("features", array_to_vector("x"))
    model = tr.BestFirstBoosting(maxIter=1, stepSize=1.0, maxLeaves=8, minRows=8).fit(df)
    counts = sorted(r.row_count for r in model.leaf_rows(df).collect())
    assert sum(counts) == 80 and len(counts) == 8 and counts[0] >= 8


def test_nothing_to_split(spark):
    df = spark.createDataFrame([([1.0], 0.0)] * 9 + [([1.0], 1.0)] * 9, "x array<double>, label double")
    df = df.withColumn("features", array_to_vector("x"))
    model = tr.BestFirstBoosting(maxIter=2).fit(df)
    assert {r.row_count for r in model.leaf_rows(df).collect()} == {18}
    assert model.transform(df.limit(0)).count() == 0


def test_histograms_stay_in_the_tasks(spark, table, monkeypatch):
    """A fit sends the best splits to the driver, not the sums of all bins."""
    monkeypatch.setattr(tr, "_TASK_ROWS", 60)
    sent, collect = [], tr.RDD.collect

    def counted(rdd):
        out = collect(rdd)
        sent.append(len(pickle.dumps(out)))
        return out

    def whole(rdd, add):
        raise AssertionError("sums of all bins at the driver")

    monkeypatch.setattr(tr.RDD, "collect", counted)
    monkeypatch.setattr(tr.RDD, "reduce", whole)
    monkeypatch.setattr(tr.RDD, "treeReduce", whole)
    tr.BestFirstBoosting(weightCol="weight", maxIter=2, maxLeaves=15, minRows=8).fit(frame(spark, table, 5))
    assert sent and max(sent) < 3 * 8 * 30 * (tr.BINS + 1)


@pytest.mark.parametrize("leaves", [1, 2, 15, 16, 17, 64, 65])
def test_tables_reach_the_leaf_a_walk_reaches(leaves):
    chance = np.random.default_rng(leaves)
    tree, open_ = tr._Tree(), [0]
    while len(open_) < leaves:
        open_ += tree.split(open_.pop(int(chance.integers(len(open_)))), int(chance.integers(5)), int(chance.integers(255)))
    for node in open_:
        tree.value[node] = float(chance.normal())
    bins = chance.integers(0, 256, (3000, 5)).astype(np.uint8)
    walked = tr._reach(bins, tree.arrays())
    table, columns = tr._Table(tree.arrays(), [256] * 5), np.ascontiguousarray(bins.T)
    assert (table.reach(columns) == walked).all()
    assert (table.added(columns) == tree.arrays()[4][walked]).all()


def test_a_tree_like_one_before_takes_one_job(spark, table, monkeypatch):
    """Nodes are looked at ahead where earlier trees were split; wrong expectations change nothing."""
    monkeypatch.setattr(tr, "_TASK_ROWS", 100)
    jobs, collect = [], tr.RDD.collect
    monkeypatch.setattr(tr.RDD, "collect", lambda rdd: jobs.append(1) or collect(rdd))

    def fitted(rounds, step):
        jobs.clear()
        df = frame(spark, table, 3)
        model = tr.BestFirstBoosting(weightCol="weight", maxIter=rounds, stepSize=step, maxLeaves=6, minRows=8).fit(df)
        return model.getOrDefault(model.trees), len(jobs)

    first = fitted(1, 0.0)[1]
    assert first > 2 and fitted(4, 0.0)[1] == first + 3
    found, few = fitted(8, 0.5)
    monkeypatch.setattr(tr, "_remember", lambda *_: None)
    unaided, many = fitted(8, 0.5)
    assert found == unaided and few < many
