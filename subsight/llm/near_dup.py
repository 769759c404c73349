"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of sub-keys are computed per document, each sub-key
from ``width`` minhashes.  A table key is a pair of one sub-key from either
collection, so ``count`` + ``count`` sub-keys give ``count`` x ``count`` tables and
minhash work is about the square root of what independent tables need.  Two
documents meet in a table iff they share a sub-key in both collections: at a
similarity s the chance of missing a pair is at most
2 * (1 - s**width)**count, 1.1e-5 for s = 0.85, width 2, count 10.

What a table proposes is verified on full shingle sets.  Nothing is emitted
for all pairs of a bucket: documents with equal sets are one node; each bucket
links its members to a hub; only members that this leaves in different
components are compared with each other, after an exact bound has removed
those that cannot reach the threshold with anybody.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsight.llm.graph import components
from subsight.llm.storage import release, stored
from subsight.llm.text import mix, pieces, shingles, words
from subsight.session import stable

_U = np.uint64


@dataclass(frozen=True)
class NearDup:
    """Similarity is ``percent`` of the union; shingles have ``size`` words."""

    percent: int = 85
    size: int = 5
    width: int = 2
    count: int = 10
    seed: int = 11

    def factors(self) -> np.ndarray:
        draw = np.random.Generator(np.random.PCG64(self.seed))
        return draw.integers(1, 2**63, 2 * self.count * self.width, dtype=np.uint64) | _U(1)


def _sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all documents, and their bounds."""
    w = words(column)
    values, bounds = shingles(w.hash, w.first, size)
    for d in range(len(bounds) - 1):
        values[bounds[d] : bounds[d + 1]].sort()
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    opens = bounds[:-1][bounds[:-1] < len(values)]
    fresh[opens] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return values[fresh], kept[bounds]


def sketches(docs: DataFrame, id_column: str, text: str, rule: NearDup) -> DataFrame:
    """Per row: set size, a 128-bit key of the set and the sub-keys of both collections."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = rule.factors()
        for batch in batches:
            for piece in pieces(batch, text):
                values, bounds = _sets(piece.column(text), rule.size)
                counts = np.diff(bounds)
                full = np.flatnonzero(counts)
                opens = bounds[:-1][full]
                keys = np.zeros((2, len(counts)), np.uint64)
                subs = np.zeros((2 * rule.count, len(counts)), np.uint64)
                if len(full):
                    with np.errstate(over="ignore"):
                        keys[0, full] = np.add.reduceat(mix(values + _U(1)), opens)
                        keys[1, full] = np.add.reduceat(mix(values ^ _U(0xA5A5A5A5A5A5A5A5)), opens)
                        for i in range(2 * rule.count):
                            joined = np.full(len(full), i + 1, np.uint64)
                            for j in range(rule.width):
                                hashed = values * factors[i * rule.width + j]
                                hashed ^= hashed >> _U(32)
                                joined = mix(joined + np.minimum.reduceat(hashed, opens))
                            subs[i, full] = joined
                flat = pa.array(np.ascontiguousarray(subs[:, full].T).view(np.int64).ravel())
                sizes = np.where(counts > 0, 2 * rule.count, 0)
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(id_column),
                        pa.array(counts.astype(np.int64)),
                        pa.array(keys[0].view(np.int64)),
                        pa.array(keys[1].view(np.int64)),
                        pa.ListArray.from_arrays(offsets, flat),
                    ],
                    names=["doc_id", "n_shingles", "key_a", "key_b", "subs"],
                )

    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias(id_column), F.col(f"`{text}`").cast("string").alias(text))
    return rows.mapInArrow(build, "doc_id bigint, n_shingles bigint, key_a bigint, key_b bigint, subs array<bigint>")


def shingle_sets(docs: DataFrame, id_column: str, text: str, size: int) -> DataFrame:
    """``doc_id`` and the sorted distinct shingle hashes of each row."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                values, bounds = _sets(piece.column(text), size)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([piece.column(id_column), lists], names=["node", "shingles"])

    return docs.select(id_column, text).mapInArrow(build, "node bigint, shingles array<bigint>")


def _reaches(overlap: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return overlap * 100 >= (n_a + n_b - overlap) * percent


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    overlap = F.size(F.array_intersect("set_a", "set_b"))
    joined = pairs.select("a", "b").join(first, "a").join(second, "b")
    return joined.where(_reaches(overlap, F.size("set_a"), F.size("set_b"), percent)).select("a", "b")


#: Buckets up to this size compare their components pairwise right away.
SMALL_BUCKET = 16


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", rule: NearDup = NearDup()
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest id linked with the document over any
    number of steps, ``kept`` whether that is its own.  NULL and blank texts
    have no shingles and are linked with nothing; fewer words than a shingle
    make one shingle of the whole text.  Rows with the same id are the same
    document.  Rows without an id are linked through equal sets only and never
    kept.  An empty table gives no rows; other columns are ignored.
    """
    sketch = stable(sketches(docs, id_column, text, rule))
    full = sketch.where("n_shingles > 0")
    # stored, so that the join below deals anew and can split a class of many copies
    classes = stable(full.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("node")))
    placed = stable(
        full.select("doc_id", "n_shingles", "key_a", "key_b").join(classes, ["key_a", "key_b"]).drop("key_a", "key_b")
    )
    heads = full.where("doc_id is not null").join(
        placed.where("doc_id = node").select("doc_id").distinct(), "doc_id", "left_semi"
    )
    heads = heads.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "subs").dropDuplicates(["node"])

    own = stable(_shared_sub_keys(heads, rule))
    bands = _table_keys(own)
    buckets = bands.groupBy("key").agg(
        F.max(F.struct("pop", F.negative("node").alias("m"), "n")).alias("hub"), F.count(F.lit(1)).alias("members")
    )
    buckets = buckets.where("members > 1").select(
        "key", "members", F.negative("hub.m").alias("hub"), F.col("hub.n").alias("hub_n")
    )
    members = stable(bands.join(buckets, "key"))
    # what made these tables is of no use any more
    release(docs.sparkSession)

    # a bucket's hub against every member
    possible = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * rule.percent
    stars = members.where((F.col("node") != F.col("hub")) & possible).select(
        F.col("hub").alias("a"), F.col("node").alias("b")
    )
    candidates = members.select("node").distinct()
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("node"), F.col(f"`{text}`").cast("string").alias("text"))
    sets = stable(shingle_sets(rows.join(candidates, "node", "left_semi"), "node", "text", rule.size))
    links = stable(_verified(stars.distinct(), sets, rule.percent))
    found = components(links)
    release(docs.sparkSession)

    rest = _left_over(members, own, found, sets, rule)
    links = links.union(_verified(rest, sets, rule.percent))
    found = components(links)
    return _labelled(sketch, placed, found)


def _shared_sub_keys(heads: DataFrame, rule: NearDup) -> DataFrame:
    """Per node its sub-keys of either collection, in order.

    A sub-key that no other node has leads nowhere, in any of its tables, and
    is left out; ``pop`` counts how often the others occur.
    """
    subs = heads.select("node", "n", F.posexplode("subs").alias("slot", "sub"))
    shared = subs.groupBy("sub").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    kept = subs.join(shared, "sub").groupBy("node", "n").agg(
        F.sum("many").alias("pop"), F.collect_list(F.struct("slot", "sub")).alias("own")
    )
    own_a, own_b = (
        F.transform(F.array_sort(F.filter("own", side)), lambda s: s["sub"])
        for side in (lambda s: s["slot"] < rule.count, lambda s: s["slot"] >= rule.count)
    )
    return kept.select("node", "n", "pop", own_a.alias("own_a"), own_b.alias("own_b"))


def _table_keys(own: DataFrame) -> DataFrame:
    """A row per node and table in which it can meet another node."""
    pairs = F.flatten(F.transform("own_a", lambda x: F.transform("own_b", lambda y: F.xxhash64(x, y))))
    return own.select("node", "n", "pop", F.explode(pairs).alias("key"))


def _left_over(
    members: DataFrame, own: DataFrame, found: DataFrame, sets: DataFrame, rule: NearDup
) -> DataFrame:
    """Pairs of a bucket that the hubs have left in different components.

    Each pair comes from one table only, the first that its members share.
    """
    labelled = members.drop("hub_n", "pop").join(found.select("node", "component"), "node", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    # buckets whose members are all in one component need no more comparing
    open_keys = labelled.groupBy("key").agg(
        F.min("component").alias("lo"),
        F.max("component").alias("hi"),
        F.min("n").alias("least"),
        F.max(F.when(F.col("node") == F.col("hub"), F.col("component"))).alias("main"),
    )
    labelled = stable(labelled.join(open_keys.where("lo < hi").select("key", "least", "main"), "key"))

    large = labelled.where(F.col("members") > SMALL_BUCKET)
    inside = large.select("node").distinct()
    shingle = sets.join(inside, "node", "left_semi").select("node", F.explode("shingles").alias("shingle"))
    common = shingle.groupBy("shingle").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("shingle")
    shared = shingle.join(common, "shingle", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("shared"))
    # the overlap with any other member is at most the shingles that anyone shares
    large = large.join(shared, "node").where(
        _reaches(F.col("shared"), F.col("n"), F.greatest("shared", "least"), rule.percent)
    )
    columns = ["key", "node", "n", "component", "main", "shared"]
    open_members = labelled.where(F.col("members") <= SMALL_BUCKET).withColumn("shared", F.col("n")).select(columns)
    open_members = stable(open_members.union(large.select(columns)).join(own.select("node", "own_a", "own_b"), "node"))

    # members of the hub's component are done with each other
    one, two = open_members.where("component <> main").alias("x"), open_members.alias("y")
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    first = F.xxhash64(
        F.get(F.array_intersect("x.own_a", "y.own_a"), F.lit(0)), F.get(F.array_intersect("x.own_b", "y.own_b"), F.lit(0))
    )
    joined = one.join(
        two,
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.component") != F.col("y.component"))
        & once
        & _reaches(F.least("x.shared", "y.shared"), F.col("x.n"), F.col("y.n"), rule.percent)
        & (F.col("x.key") == first),
    )
    return joined.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _labelled(sketch: DataFrame, placed: DataFrame, found: DataFrame) -> DataFrame:
    nodes = placed.join(found, "node", "left")
    nodes = nodes.select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    empty = sketch.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return nodes.union(empty).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )


def drop_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", rule: NearDup = NearDup()
) -> DataFrame:
    """The documents that stay: one of each group, with all their columns.

    Rows without an id stay, as do all rows of a document that stays.  The
    dropped ids are stored first: texts are shuffled for this join only where
    the ids are too many to be broadcast.
    """
    out = near_duplicates(docs, id_column, text, rule).where("not kept and doc_id is not null")
    out = stored(out.select(F.col("doc_id").alias(_free_name("dropped_id", docs))).distinct(), "near-duplicates")
    return docs.join(out, docs[f"`{id_column}`"].cast("bigint") == out[out.columns[0]], "left_anti")


def _free_name(wanted: str, docs: DataFrame) -> str:
    """A column name that the documents do not use."""
    while wanted.lower() in (c.lower() for c in docs.columns):
        wanted += "_"
    return wanted
