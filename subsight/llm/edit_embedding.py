"""Document fingerprints by randomised edit embedding.

A shared random walk reads each text: at step j the character under the
pointer is put out, and the pointer advances iff a random bit shared by all
texts for (j, character) is one.  Texts that differ by few edits fall back into
step soon after each edit, so that their outputs agree at most steps: edit
distance becomes Hamming distance.  The output of step j is a random sign for
(j, character), added into bin j mod ``bins``; the signs of the bins are the
fingerprint.  Every character of the text takes part.

The share of steps at which two texts agree is the correlation of their bins,
and the agreement of the signs gives it back by the arcsine law.

Long texts restart the walk every ``segment`` characters, so that a huge
document does not become one long sequential loop.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subsight.llm.text import pieces

_CLASSES = 256
_END = 0  # class that stops the walk


@dataclass(frozen=True)
class EditRule:
    bins: int = 512
    segment: int = 16_384
    seed: int = 29

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Advance bit and sign by (step, class); steps repeat after a while."""
        draw = np.random.Generator(np.random.PCG64(self.seed))
        steps = 16 * self.bins
        advance = draw.integers(0, 2, (steps, _CLASSES), dtype=np.int64)
        sign = draw.integers(0, 2, (steps, _CLASSES), dtype=np.int16) * 2 - 1
        advance[:, _END] = 0
        sign[:, _END] = 0
        return advance, sign.astype(np.int16)


def _classes(text: str) -> np.ndarray:
    """Characters hashed to 1..255."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return ((points * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(_CLASSES - 1) + np.uint32(1)).astype(np.uint8)


class Embedder:
    def __init__(self, rule: EditRule = EditRule()):
        self.rule = rule
        self.advance, self.sign = rule.tables()

    def bins(self, texts: list[str]) -> np.ndarray:
        """Sum of signs by text and bin; all texts walk at the same time."""
        rule = self.rule
        parts, starts, owners, at = [], [], [], 0
        for i, text in enumerate(texts):
            coded = _classes(text)
            for lo in range(0, len(coded), rule.segment):
                part = coded[lo : lo + rule.segment]
                parts += [part, np.zeros(1, np.uint8)]
                starts.append(at)
                owners.append(i)
                at += len(part) + 1
        total = np.zeros((rule.bins, len(texts)), np.int32)
        if not parts:
            return total.T
        symbol = np.concatenate(parts)
        pointer, owner = np.array(starts, np.int64), np.array(owners, np.int64)
        sums = np.zeros((rule.bins, len(pointer)), np.int16)
        now = np.empty(len(pointer), np.uint8)
        step, period = 0, len(self.advance)
        while len(pointer):
            np.take(symbol, pointer, out=now)
            row = step % period
            sums[step % rule.bins] += self.sign[row][now]
            pointer += self.advance[row][now]
            step += 1
            if step % 128 == 0:
                alive = symbol[pointer] != _END
                count = int(alive.sum())
                if count <= 0.8 * len(pointer):
                    _settle(total, sums[:, ~alive], owner[~alive])
                    pointer, owner = pointer[alive], owner[alive]
                    sums = np.ascontiguousarray(sums[:, alive])
                    now = np.empty(count, np.uint8)
        return total.T

    def fingerprints(self, texts: list[str]) -> np.ndarray:
        """-1, 0 or 1 by text and bin; all 0 for an empty text."""
        return np.sign(self.bins(texts)).astype(np.int8)


def _settle(total: np.ndarray, sums: np.ndarray, owner: np.ndarray) -> None:
    if len(owner):
        # segments of a text are neighbours
        heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        total[:, owner[heads]] += np.add.reduceat(sums, heads, axis=1, dtype=np.int32)


def to_hex(prints: np.ndarray) -> list[str]:
    """Positive bins, then non-zero bins, as hexadecimal digits."""
    packed = np.concatenate([np.packbits(prints > 0, axis=1), np.packbits(prints != 0, axis=1)], axis=1)
    return [row.tobytes().hex() for row in packed]


def from_hex(text: str) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(bytes.fromhex(text), np.uint8)).astype(np.int8)
    positive, filled = np.split(bits, 2)
    return positive * 2 - filled


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of equal steps, 0 to 1, of fingerprints row by row.

    Two empty texts are alike, an empty and another one are not.
    """
    dot = (a.astype(np.int32) * b).sum(axis=-1)
    size_a, size_b = np.abs(a).sum(axis=-1, dtype=np.int64), np.abs(b).sum(axis=-1, dtype=np.int64)
    norm = np.sqrt(size_a * size_b)
    with np.errstate(invalid="ignore", divide="ignore"):
        share = np.sin(np.pi / 2 * np.clip(dot / norm, 0, 1))
    return np.where(norm > 0, share, (size_a == size_b).astype(float))


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, one machine-independent bit vector per column."""
    if not a or not b:
        return len(a) + len(b)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    plus, minus, score = full, 0, len(a)
    for c in b:
        equal = where.get(c, 0)
        vertical = equal | minus
        equal |= ((equal & plus) + plus) ^ plus
        up, down = minus | ~(equal | plus) & full, plus & equal
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1 | 1) & full, (down << 1) & full
        plus, minus = down | ~(vertical | up) & full, up & vertical
    return score


def fingerprint_documents(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", rule: EditRule = EditRule()
) -> DataFrame:
    """Per row: id, n_chars and the fingerprint in hexadecimal; no shuffle.

    NULL counts as empty text, whose fingerprint is all zeros.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embedder = Embedder(rule)
        for batch in batches:
            for piece in pieces(batch, text, 16 << 20):
                texts = [t or "" for t in piece.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(id_column),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array(to_hex(embedder.fingerprints(texts)), pa.string()),
                    ],
                    names=[id_column, "n_chars", "fingerprint"],
                )

    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias(id_column), F.col(f"`{text}`").cast("string").alias(text))
    return rows.mapInArrow(build, f"`{id_column}` bigint, n_chars bigint, fingerprint string")


def near_pairs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    least: float = 0.8,
    bands: int = 48,
    sampled: int = 12,
    rule: EditRule = EditRule(),
) -> DataFrame:
    """Pairs (a, b, distance) of documents with edit similarity ``least`` or more.

    Each of ``bands`` tables samples ``sampled`` bins of the fingerprint.
    Equal texts are one node, named by its smallest id.  A bucket proposes each
    member with its smallest member and with the one before it, so its
    proposals grow with its size; they are verified by exact edit distance
    over the longer length.  Empty texts and rows without an id take no part.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.where("id is not null and length(text) > 0")
    nodes = rows.groupBy("text").agg(F.min("id").alias("id"))
    prints = fingerprint_documents(nodes, "id", "text", rule)

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.Generator(np.random.PCG64(rule.seed + 1))
        chosen = [draw.choice(rule.bins, sampled, replace=False) for _ in range(bands)]
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.stack([from_hex(t) for t in batch.column("fingerprint").to_pylist()])
            keys = np.concatenate([[f"{i}:{v.tobytes().hex()}" for v in values[:, c]] for i, c in enumerate(chosen)])
            ids = np.tile(batch.column("id").to_numpy(), bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ids)], names=["key", "id"])

    banded = prints.select("id", "fingerprint").mapInArrow(tables, "key string, id bigint")
    heads = banded.groupBy("key").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("many")).where("many > 1")
    first = banded.join(heads.drop("many"), "key").where("id <> a").select("a", F.col("id").alias("b"))
    # rows of a bucket over 4096 spread over parts before they are put in order
    part = F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), F.floor(F.col("many") / 4096)))
    ordered = Window.partitionBy("key", "part").orderBy("id")
    before = banded.join(heads.drop("a"), "key").withColumn("part", part).withColumn("a", F.lag("id").over(ordered))
    proposed = first.union(before.where("a is not null").select("a", F.col("id").alias("b"))).distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
            far = [edit_distance(x, y) for x, y in zip(a, b)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(far, pa.int64()),
                 pa.array([max(len(x), len(y)) for x, y in zip(a, b)], pa.int64())],
                names=["a", "b", "distance", "longest"],
            )

    texts_a = nodes.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    texts_b = nodes.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    joined = proposed.join(texts_a, "a").join(texts_b, "b").select("a", "b", "text_a", "text_b")
    checked = joined.mapInArrow(verify, "a bigint, b bigint, distance bigint, longest bigint")
    return checked.where(F.col("distance") <= F.col("longest") * (1 - least) + 1e-9).select("a", "b", "distance")


def with_next(docs: DataFrame, buckets: int) -> tuple[DataFrame, int]:
    """Rows dealt out by id range, each range with the row that follows it.

    Columns: id, text, bucket, and whether the row only ends its bucket.
    Ids descend; the row after the last one is the first.  Rows without an id
    come last.  Texts are shuffled once.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 10 * buckets)).first()[0] if shares else []
    splits = [float("-inf"), *sorted({float(c) for c in cuts or [0]}), float("inf")]
    # rows without an id get the bucket after the last, which stands for -1 here
    sorter = Bucketizer(splits=splits, inputCol="_at", outputCol="_bucket", handleInvalid="keep")
    dealt = sorter.transform(rows.withColumn("_at", F.col("doc_id").cast("double"))).drop("_at")
    extra = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.col("_bucket").cast("int"))
    dealt = dealt.withColumn("bucket", extra).drop("_bucket")
    nameless = F.col("doc_id").isNull()
    text_or_empty = F.coalesce("text", F.lit(""))
    # one row per bucket
    tops = {
        r[0]: r[2] if r[1] is None else str(r[1])
        for r in dealt.groupBy("bucket")
        .agg(F.max("doc_id"), F.sha2(F.min(F.when(nameless, text_or_empty)), 256))
        .collect()
    }
    order = sorted(tops, reverse=True)
    leads = [(tops[here], previous) for here, previous in zip(order, [*order[-1:], *order[:-1]])]
    leads = docs.sparkSession.createDataFrame(leads, "_lead string, _previous int")
    name = F.when(nameless, F.sha2(text_or_empty, 256)).otherwise(F.col("doc_id").cast("string"))
    # bounded by the number of buckets
    placed = dealt.withColumn("_lead", name).join(F.broadcast(leads), "_lead", "left")
    both = F.array_compact(F.array("bucket", "_previous"))
    placed = placed.select("doc_id", "text", F.posexplode(both).alias("_nth", "bucket"))
    placed = placed.withColumn("follows", F.col("_nth") > 0)
    return placed.drop("_nth"), len(order)


def edited_fingerprints(docs: DataFrame, rule: EditRule = EditRule(), buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edit with the next document.

    The edit replaces the last floor(n_chars / 2) characters by as many (or
    all) first ones of the next document, ids descending, the first after the
    last.  Among rows with one id smaller texts come first.
    """
    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed, _ = with_next(docs, buckets or 8 * parallel)
    spread = placed.repartition(parallel, "bucket").sortWithinPartitions(
        "bucket", "follows", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first()
    )
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def digest(embedder: Embedder, held: list[tuple]) -> pa.RecordBatch:
        texts = [t for _, t, _ in held]
        following = [n for _, _, n in held]
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, following)]
        distinct = list(dict.fromkeys([*texts, *following, *edited]))
        number = {t: i for i, t in enumerate(distinct)}
        prints = embedder.fingerprints(distinct)
        mine, theirs, new = (prints[[number[t] for t in part]] for part in (texts, following, edited))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _, _ in held], pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array(to_hex(mine)),
                pa.array(to_hex(new)),
                pa.array(likeness(mine, new)),
                pa.array(likeness(mine, theirs)),
            ],
            names=names,
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embedder = Embedder(rule)
        held, size, last = [], 0, None
        for batch in batches:
            for piece in pieces(batch, "text"):
                columns = (piece.column(n).to_pylist() for n in ("doc_id", "text", "bucket", "follows"))
                for doc, text, bucket, follows in zip(*columns):
                    text = text or ""
                    if last is not None and last[2] == bucket:
                        held.append((last[0], last[1], text))
                        size += len(last[1])
                    last = None if follows else (doc, text, bucket)
                if size > 12 << 20:
                    yield digest(embedder, held)
                    held, size = [], 0
        if held:
            yield digest(embedder, held)

    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return spread.mapInArrow(build, schema)
