"""Gradient-boosted trees grown best first over distributed histograms.

Spark ML grows trees level by level.  Here the leaf with the greatest gain is
split next, until a tree has ``maxLeaves`` leaves, and a leaf keeps at least
``minRows`` rows.  Inputs are put into at most 255 bins at quantiles; a job sums
gradient, curvature and rows per leaf, input and bin.  Tasks add up their own
rows, the sums of one input meet in one task, which looks for its best split,
and only that split of each leaf goes to the driver.  Children of all leaves
that may still be split are summed in one job, ahead of the choice, together
with the nodes that would follow if they were split as in earlier trees, so a
tree takes a few jobs and not one per split; the choice itself is the same.

Gradients are rounded to multiples of 2**-20, which makes sums exact: the trees
do not depend on how rows are dealt over tasks.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasStepSize, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 255
_UNIT = float(1 << 20)
#: Trees applied afresh in every job before their sum is kept with the rows.
_FRESH = 10
#: Rows of a block at least, but for the last of a task.
_BLOCK_ROWS = 50_000
#: Least rows worth a task of their own in each of the many small jobs.
_TASK_ROWS = 50_000
#: Tasks among which the inputs are dealt to look for splits.
_SEEKERS = 4
#: Nodes, about, that a job looks at before it is known whether they will be asked for.
_NODES_AHEAD = 60
_LEAST_CURVATURE = 1e-3


class _Tree:
    """Nodes in order of creation; an inner node has a feature, a bin and two children."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.value = [-1], [0], [-1], [-1], [0.0]

    def split(self, node: int, feature: int, bin_: int) -> tuple[int, int]:
        left = len(self.feature)
        for values, blank in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            values += [blank, blank]
        self.feature[node], self.bin[node], self.left[node], self.right[node] = feature, bin_, left, left + 1
        return left, left + 1

    def pruned(self, leaves: set[int]) -> _Tree:
        """The same tree down to ``leaves`` only."""
        out = _Tree()
        waiting = [(0, 0)]
        for old, new in waiting:
            if old in leaves:
                out.value[new] = self.value[old]
            else:
                below = out.split(new, self.feature[old], self.bin[old])
                waiting += zip((self.left[old], self.right[old]), below)
        return out

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(v) for v in (self.feature, self.bin, self.left, self.right, self.value))


def _reach(values: np.ndarray, tree: tuple[np.ndarray, ...]) -> np.ndarray:
    """Leaf of every row; rows go left where their value is not above the node's."""
    feature, cut, left, right, _ = tree
    at = np.zeros(len(values), np.int64)
    rows = np.arange(len(values))
    while len(rows):
        rows = rows[feature[at[rows]] >= 0]
        here = at[rows]
        goes = values[rows, feature[here]] <= cut[here]
        at[rows] = np.where(goes, left[here], right[here])
    return at


#: Place of the only bit set in 16.
_PLACE = np.zeros(1 << 16, np.uint8)
_PLACE[1 << np.arange(16)] = np.arange(16)


class _Table:
    """A tree as one table per input: which leaves a row in a bin of the input may reach.

    A row reaches the one leaf that all its inputs allow, so a tree costs a
    look-up per input it uses and no walk from node to node.
    """

    def __init__(self, tree: tuple[np.ndarray, ...], widths: list[int]):
        feature, cut, left, right, value = tree
        below, order = {}, []
        waiting = [(0, False)]
        while waiting:  # leaves under each node, without recursion: trees may be deep
            node, seen = waiting.pop()
            if feature[node] < 0:
                below[node] = 1 << len(order)
                order.append(node)
            elif seen:
                below[node] = below[left[node]] | below[right[node]]
            else:
                waiting += [(node, True), (right[node], False), (left[node], False)]
        self.leaves = np.array(order)
        self.tree, self.masks = tree, None
        if len(order) > 64:
            return
        kind = np.uint16 if len(order) <= 16 else np.uint64
        whole = (1 << len(order)) - 1
        self.masks = {}
        for node in np.flatnonzero(feature >= 0):
            if node not in below:
                continue
            held = self.masks.setdefault(int(feature[node]), np.full(widths[feature[node]], whole, kind))
            held[: int(cut[node]) + 1] &= kind(whole & ~below[right[node]])
            held[int(cut[node]) + 1 :] &= kind(whole & ~below[left[node]])
        self.values = value[self.leaves]

    def places(self, columns: np.ndarray) -> np.ndarray:
        """Leaf of every row, counted from the left; ``columns`` holds the bins input by input."""
        found = None
        for feature, mask in self.masks.items():
            allowed = mask.take(columns[feature])
            found = allowed if found is None else np.bitwise_and(found, allowed, out=found)
        if found is None:
            return np.zeros(columns.shape[1], np.uint8)
        return _PLACE.take(found) if found.dtype == np.uint16 else np.frexp(found.astype(np.float64))[1] - 1

    def reach(self, columns: np.ndarray) -> np.ndarray:
        """Leaf of every row as a node."""
        return _reach(columns.T, self.tree) if self.masks is None else self.leaves.take(self.places(columns))

    def added(self, columns: np.ndarray) -> np.ndarray:
        if self.masks is None:
            return self.tree[4][_reach(columns.T, self.tree)]
        return self.values.take(self.places(columns))


def _tables(trees: list[tuple[np.ndarray, ...]]) -> tuple[list[np.ndarray], list[_Table]]:
    """Trees over raw values as the values they compare with, by input, and tables over their bins."""
    used = max((int(t[0].max()) for t in trees), default=-1) + 1
    edges = [np.unique(np.concatenate([t[1][t[0] == f] for t in trees])).astype(float) for f in range(used)]
    tables = []
    for feature, cut, *rest in trees:
        bins = [int(np.searchsorted(edges[f], c)) if f >= 0 else 0 for f, c in zip(feature.tolist(), cut.tolist())]
        tables.append(_Table((feature, np.array(bins), *rest), [len(e) + 1 for e in edges]))
    return edges, tables


def _binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins input by input; a value is in the first bin whose end it does not exceed."""
    kind = np.uint8 if max(map(len, edges), default=0) < 256 else np.int64
    columns = np.empty((len(edges), len(values)), kind)
    for place, edge in enumerate(edges):
        columns[place] = np.searchsorted(edge, values[:, place], side="left")
    return columns


def _added(columns: np.ndarray, tables: list[_Table]) -> np.ndarray:
    total = np.zeros(columns.shape[1])
    for table in tables:
        total += table.added(columns)
    return total


def _add_block(out: np.ndarray, block, fresh: list[_Table], partial: _Table, slot: np.ndarray, widths: list[int]) -> None:
    """Add gradient, curvature and rows by wanted node and bin, the bins of all features in a row."""
    columns, label, weight, score = block
    score = score + _added(columns, fresh)
    chance = 1.0 / (1.0 + np.exp(-score))
    slope = np.rint(weight * (chance - label) * _UNIT)
    curve = np.rint(weight * chance * (1.0 - chance) * _UNIT)
    place = slot.take(partial.reach(columns))
    if place.min(initial=0) < 0:
        kept = np.flatnonzero(place >= 0)
        place, slope, curve, columns = place[kept], slope[kept], curve[kept], columns[:, kept]
    nodes, first = out.shape[1], 0
    for feature, width in enumerate(widths):
        key = place * width + columns[feature]
        for part, weights in enumerate((slope, curve, None)):
            sums = np.bincount(key, weights, nodes * width)
            out[part, :, first : first + width] += sums.reshape(nodes, width)
        first += width


#: Best split of a node, (gain, feature, bin), if there is one; its gradient and curvature.
_Look = tuple[tuple[float, int, int] | None, float, float]


def best_splits(feature: int, sums: np.ndarray, least_rows: int) -> list[_Look]:
    """Each node's best split by one feature; the first of equal ones."""
    total = sums.sum(axis=2)
    left = sums.cumsum(axis=2)
    right = total[:, :, None] - left
    whole = total[0] ** 2 / np.maximum(total[1], _LEAST_CURVATURE * _UNIT)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - whole[:, None]
    allowed = (left[2] >= least_rows) & (right[2] >= least_rows)
    allowed &= (left[1] >= _LEAST_CURVATURE * _UNIT) & (right[1] >= _LEAST_CURVATURE * _UNIT)
    gain = np.where(allowed, gain, -np.inf)
    out = []
    for node, bin_ in enumerate(gain.argmax(axis=1).tolist()):
        best = float(gain[node, bin_])
        # in units of the rounding: anything above a rounding error
        out.append(((best, feature, bin_) if best > 1.0 else None, float(total[0, node]), float(total[1, node])))
    return out


def _better(a: list[_Look], b: list[_Look]) -> list[_Look]:
    """Node by node the greater gain, of equal ones the first feature's."""
    def rank(look):
        return (look[0][0], -look[0][1]) if look[0] else (-np.inf, 0)

    return [x if rank(x) >= rank(y) else y for x, y in zip(a, b)]


def grow(look_at, most_leaves: int, step: float) -> tuple[_Tree, _Tree]:
    """One tree, and the same with all nodes looked at.

    ``look_at(tree, nodes)`` gives the best splits and the sums of some of its nodes.
    """
    tree = _Tree()
    seen = {0: look_at(tree, [0])[0]}
    leaves, ahead = {0}, set()
    while len(leaves) < most_leaves:
        open_ = sorted((n for n in leaves if seen[n][0]), key=lambda n: (-seen[n][0][0], n))
        if not open_:
            break
        if open_[0] not in ahead:
            # no more of these can be split than there are leaves to come
            chosen = [n for n in open_[: most_leaves - len(leaves)] if n not in ahead]
            children = [child for n in chosen for child in tree.split(n, *seen[n][0][1:])]
            seen.update(zip(children, look_at(tree, children)))
            ahead.update(chosen)
        node = open_[0]
        leaves.remove(node)
        leaves.update((tree.left[node], tree.right[node]))
    for node in leaves:
        _, slope, curve = seen[node]
        tree.value[node] = -step * slope / max(curve, _LEAST_CURVATURE * _UNIT)
    return tree.pruned(leaves), tree


class _Foresight:
    """Looks at nodes of one tree together with those that are likely to be asked for next.

    A node is expected to be split as it was when last met, after the same
    splits or else after splits by the same inputs.  An expectation that turns
    out wrong is not used, so the answers are those of looking at each node
    when it is asked for.  ``search(tree, nodes)`` is one job.
    """

    def __init__(self, search, past: dict[tuple, tuple[int, int]]):
        self.search, self.past = search, past
        self.known: dict[tuple, _Look] = {}

    def __call__(self, tree: _Tree, nodes: list[int]) -> list[_Look]:
        path = _paths(tree)
        if any(path[n] not in self.known for n in nodes):
            guessed = copy.deepcopy(tree)
            waiting = [(n, path[n]) for n in nodes if path[n] not in self.known]
            for node, before in waiting:
                split = self.past.get(before, self.past.get(_inputs(before)))
                if split and len(waiting) < _NODES_AHEAD:
                    waiting += [(child, (*before, (*split, side))) for side, child in enumerate(guessed.split(node, *split))]
            looks = self.search(guessed, [node for node, _ in waiting])
            self.known.update(zip((before for _, before in waiting), looks))
        return [self.known[path[n]] for n in nodes]


def _paths(tree: _Tree) -> dict[int, tuple]:
    """(input, bin, side) of every step to each node."""
    path, waiting = {0: ()}, [0]
    for node in waiting:
        if tree.feature[node] >= 0:
            for side, child in enumerate((tree.left[node], tree.right[node])):
                path[child] = (*path[node], (tree.feature[node], tree.bin[node], side))
                waiting.append(child)
    return path


def _inputs(path: tuple) -> tuple:
    """The same steps without the bins."""
    return tuple((feature, side) for feature, _, side in path)


def _remember(past: dict[tuple, tuple[int, int]], tree: _Tree) -> None:
    """Note how the nodes of a finished tree were split."""
    for node, path in _paths(tree).items():
        if tree.feature[node] >= 0:
            past[path] = past[_inputs(path)] = (tree.feature[node], tree.bin[node])


def _leaves_below(tree: _Tree, nodes: list[int]) -> list[set[int]]:
    found = []
    for node in nodes:
        leaves, waiting = set(), [node]
        while waiting:
            at = waiting.pop()
            if tree.feature[at] < 0:
                leaves.add(at)
            else:
                waiting += [tree.left[at], tree.right[at]]
        found.append(leaves)
    return found


class _Settings(HasFeaturesCol, HasLabelCol, HasWeightCol, HasMaxIter, HasStepSize):
    maxLeaves = Param(Params._dummy(), "maxLeaves", "most leaves of a tree", TypeConverters.toInt)
    minRows = Param(Params._dummy(), "minRows", "least rows of a leaf", TypeConverters.toInt)


class BestFirstBoosting(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Log-loss boosting of a 0/1 label; weights default to one."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, maxIter=200, stepSize=0.05, maxLeaves=15, minRows=8):
        super().__init__()
        self._setDefault(maxIter=200, stepSize=0.05, maxLeaves=15, minRows=8)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> BestFirstModel:
        cuts = self._cuts(dataset)
        blocks = self._blocks(dataset, cuts)
        try:
            trees = self._boost(blocks, [len(c) + 1 for c in cuts])
        finally:
            blocks.unpersist()
        return BestFirstModel(featuresCol=self.getFeaturesCol(), trees=_with_values(trees, cuts))

    def _values(self, dataset: DataFrame) -> DataFrame:
        weight = F.col(self.getWeightCol()) if self.isDefined(self.weightCol) else F.lit(1.0)
        return dataset.select(
            vector_to_array(self.getFeaturesCol()).alias("x"),
            F.col(self.getLabelCol()).cast("double").alias("label"),
            weight.cast("double").alias("weight"),
        )

    def _cuts(self, dataset: DataFrame) -> list[list[float]]:
        """Upper ends of the bins of each input: distinct quantiles, one list per input."""
        rows = self._values(dataset)
        first = rows.select(F.size("x")).first()
        names = [f"x{i}" for i in range(first[0] if first else 0)]
        wide = rows.select(*[F.col("x")[i].alias(n) for i, n in enumerate(names)])
        shares = [(i + 1) / (BINS + 1) for i in range(BINS)]
        found = wide.approxQuantile(names, shares, 0.25 / BINS) if names else []
        return [sorted(set(values)) for values in found]

    def _blocks(self, dataset: DataFrame, cuts: list[list[float]]) -> RDD:
        """Rows as arrays in blocks, kept for all jobs."""
        edges = [np.array(c) for c in cuts]

        def packed_block(parts):
            columns, label, weight = (np.concatenate(p, axis=-1) for p in zip(*parts))
            arrays = [pa.array([p.tobytes()]) for p in (columns, label, weight)]
            return pa.RecordBatch.from_arrays(arrays, names=["bins", "label", "weight"])

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, rows = [], 0
            for batch in batches:
                x = np.asarray(batch.column(0).flatten()).reshape(-1, max(len(edges), 1))
                held.append((_binned(x, edges).astype(np.uint8), *[np.asarray(batch.column(i), np.float64) for i in (1, 2)]))
                rows += len(x)
                if rows >= _BLOCK_ROWS:
                    yield packed_block(held)
                    held, rows = [], 0
            if rows:
                yield packed_block(held)

        width = len(edges)

        def unpack(row):
            label, weight = (np.frombuffer(row[i], np.float64) for i in (1, 2))
            return np.frombuffer(row[0], np.uint8).reshape(width, len(label)), label, weight, np.zeros(len(label))

        values = self._values(dataset)
        # every task sends its sums, however few its rows: no more of them than run at once
        tasks = min(-(-values.count() // _TASK_ROWS), dataset.sparkSession.sparkContext.defaultParallelism)
        packed = values.coalesce(max(tasks, 1)).mapInArrow(pack, "bins binary, label binary, weight binary")
        return packed.rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)

    def _boost(self, blocks: RDD, widths: list[int]) -> list[tuple[np.ndarray, ...]]:
        trees: list[tuple[np.ndarray, ...]] = []
        state, kept = blocks, 0
        met: dict[tuple, tuple[int, int]] = {}
        least_rows = self.getOrDefault(self.minRows)
        ends = np.cumsum(widths).tolist()
        seekers = min(len(widths), _SEEKERS)
        for _ in range(self.getMaxIter()):
            if len(trees) - kept >= _FRESH:
                # from the first blocks with all trees: nothing hangs on the state before
                past, done = state, list(trees)

                def scored(part, done=done):
                    tables = [_Table(t, widths) for t in done]
                    return ((*b[:3], _added(b[0], tables)) for b in part)

                state = blocks.mapPartitions(scored).persist(StorageLevel.MEMORY_AND_DISK)
                kept = len(trees)
                if past is not blocks:
                    past.unpersist()
            fresh, source = trees[kept:], state

            def search(tree, nodes):
                partial, ends_below = tree.arrays(), _leaves_below(tree, nodes)
                leaves = sorted(set().union(*ends_below))
                inside = np.array([[leaf in below for leaf in leaves] for below in ends_below], float)

                def summed(part):
                    grown, tables = _Table(partial, widths), [_Table(t, widths) for t in fresh]
                    slot = np.full(len(partial[0]), -1)
                    slot[leaves] = np.arange(len(leaves))
                    own = None
                    for block in part:
                        if own is None:
                            own = np.zeros((3, len(leaves), sum(widths)))
                        _add_block(own, block, tables, grown, slot, widths)
                    if own is not None:
                        yield from ((f, own[:, :, end - width : end]) for f, (end, width) in enumerate(zip(ends, widths)))

                def sought(part):
                    found = None
                    for feature, sums in part:
                        # whole numbers: sums of a node's leaves are its own
                        own = best_splits(feature, inside @ sums, least_rows)
                        found = own if found is None else _better(found, own)
                    if found is not None:
                        yield found

                sums = source.mapPartitions(summed)
                if source.getNumPartitions() > 1:
                    sums = sums.reduceByKey(np.add, seekers)
                return reduce(_better, sums.mapPartitions(sought).collect())

            tree, looked_at = grow(_Foresight(search, met), self.getOrDefault(self.maxLeaves), self.getStepSize())
            trees.append(tree.arrays())
            _remember(met, looked_at)
        if state is not blocks:
            state.unpersist()
        return trees


def _with_values(trees: list[tuple[np.ndarray, ...]], cuts: list[list[float]]) -> str:
    """Trees as JSON, bins replaced by the values they end at."""
    out = []
    for feature, bin_, left, right, value in trees:
        cut = [cuts[f][b] if f >= 0 else 0.0 for f, b in zip(feature.tolist(), bin_.tolist())]
        out.append([feature.tolist(), cut, left.tolist(), right.tolist(), value.tolist()])
    return json.dumps(out)


class BestFirstModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability``, a vector of the chances of 0 and 1."""

    trees = Param(Params._dummy(), "trees", "trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", trees="[]"):
        super().__init__()
        self._set(**self._input_kwargs)

    def arrays(self) -> list[tuple[np.ndarray, ...]]:
        return [tuple(np.array(part) for part in tree) for tree in json.loads(self.getOrDefault(self.trees))]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = self.arrays()

        @F.arrow_udf("double")
        def chance(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            edges, tables = _tables(trees)
            for x in batches:
                values = np.asarray(x.flatten()).reshape(len(x), -1) if len(x) else np.zeros((0, len(edges)))
                yield pa.array(1.0 / (1.0 + np.exp(-_added(_binned(values, edges), tables))))

        p = F.col("_chance")
        scored = dataset.withColumn("_chance", chance(vector_to_array(self.getFeaturesCol())))
        return scored.withColumn("probability", array_to_vector(F.array(1.0 - p, p))).drop("_chance")

    def parts(self):
        """For scoring by parts: what makes bins of values (input by input), the trees on bins, the inputs each reads."""
        edges, tables = _tables(self.arrays())
        reads = [set(table.tree[0][table.tree[0] >= 0].tolist()) for table in tables]
        return (lambda values: _binned(values.T, edges)), [table.added for table in tables], reads

    def leaf_rows(self, dataset: DataFrame) -> DataFrame:
        """(tree, leaf, row_count) of the rows that reach each leaf; tasks send their counts."""
        trees = self.arrays()

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = [np.zeros(len(t[0]), np.int64) for t in trees]
            edges, tables = _tables(trees)
            for batch in batches:
                if batch.num_rows:
                    columns = _binned(np.asarray(batch.column(0).flatten()).reshape(batch.num_rows, -1), edges)
                    for table, held in zip(tables, counts):
                        held += np.bincount(table.reach(columns), minlength=len(held))
            for number, (tree, held) in enumerate(zip(trees, counts)):
                leaf = np.flatnonzero(tree[0] < 0)
                columns = [np.full(len(leaf), number), leaf, held[leaf]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["tree", "leaf", "n"])

        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"))
        partial = rows.mapInArrow(build, "tree bigint, leaf bigint, n bigint")
        return partial.groupBy("tree", "leaf").agg(F.sum("n").alias("row_count"))
