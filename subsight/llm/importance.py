"""Importance resampling towards a target distribution, with Arrow kernels.

Texts are lower-cased, split and flattened by Arrow and their words dictionary
encoded; shifted dictionary indices make the runs of two and three words.  Only
distinct pairs of indices are hashed: the CRC-32 of a longer run follows from
that of the shorter one and of the word that is added, so no joined text is
ever built.  Gains are taken per distinct run, spread over its occurrences and
reduced by document.

A feature is hashed into one of a fixed number of buckets.  Bucket counts of
the raw and the target texts give each bucket's gain, the log ratio of its
smoothed shares; a document's weight is the sum over its features.  Drawing
without replacement in proportion to the weights is the top of weight plus
Gumbel noise, here from a hash of the id.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight.functions.ranking import running_totals
from subsight.llm.text import pieces
from subsight.session import stable

#: What stands between words: ASCII other than digits and lower-case letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LONGEST_RUN = 3

_CRC_POLYNOMIAL = 0xEDB88320
#: Appended lengths with a table of their own; longer ones go by powers of two.
_SHORT = 64


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by its values on each byte."""
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


@lru_cache(maxsize=1)
def _zero_bytes() -> tuple[np.ndarray, list[np.ndarray]]:
    """Effect on a CRC of appending 0 .. 63 zero bytes, and 1, 2, 4, ... of them."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> 1) ^ np.where(step & 1, np.uint32(_CRC_POLYNOMIAL), np.uint32(0))
    # the value of each byte at each of the four places
    places = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * b) for b in range(4)])
    short = [places]
    for _ in range(_SHORT - 1):
        short.append((short[-1] >> np.uint32(8)) ^ step[short[-1] & 255])
    powers = [short[1]]
    for _ in range(40):
        powers.append(_apply(powers[-1], powers[-1]))
    # place, length, byte value
    return np.ascontiguousarray(np.stack(short).transpose(1, 0, 2)), powers


def append_crc(crc: np.ndarray, added: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of joined texts from the CRC-32 of both parts and the length of the second."""
    short, powers = _zero_bytes()
    kept = length < _SHORT
    at = np.where(kept, length, 0)
    out = short[0][at, crc & 255] ^ short[1][at, crc >> 8 & 255] ^ short[2][at, crc >> 16 & 255] ^ short[3][at, crc >> 24]
    if not kept.all():
        long = np.flatnonzero(~kept)
        for bit, tables in enumerate(powers):
            own = long[(length[long] >> bit & 1) == 1]
            out[own] = _apply(tables, out[own])
    return out ^ added


class Runs(NamedTuple):
    """Runs of one size: the bucket of each distinct run, and for each occurrence its run and first word."""

    bucket: np.ndarray
    run: np.ndarray
    word: np.ndarray


class Features(NamedTuple):
    """``first[d] .. first[d + 1]`` are the words of document ``d``."""

    first: np.ndarray
    runs: list[Runs]

    def occurrences(self) -> np.ndarray:
        """Features per document."""
        held = np.diff(self.first)
        return sum(np.maximum(held - size, 0) for size in range(len(self.runs)))


def features(texts: pa.Array, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> Features:
    """All runs of one to ``longest`` words of each text (NULL: none)."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=SEPARATORS)
    flat = pc.list_flatten(lists)
    owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    encoded = flat.dictionary_encode()
    index = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # a separator at either end leaves an empty part
    empty = pc.index(encoded.dictionary, "").as_py()
    if empty >= 0:
        owner, index = owner[index != empty], index[index != empty]
    first = np.searchsorted(owner, np.arange(len(texts) + 1))

    names = [w.encode() for w in encoded.dictionary.to_pylist()]
    size = np.fromiter((len(n) + 1 for n in names), np.int64, len(names))
    added = np.fromiter((zlib.crc32(b" " + n) for n in names), np.uint32, len(names))
    crc = np.fromiter(map(zlib.crc32, names), np.uint32, len(names))
    run, at = index, np.arange(len(index))
    runs = [Runs((crc % np.uint32(buckets)).astype(np.int64), run, at)]
    for length in range(1, longest):
        inside = at + length < len(index)
        inside[inside] = owner[at[inside]] == owner[at[inside] + length]
        run, at = run[inside], at[inside]
        # pairs of a shorter run and the word behind it
        pairs = pa.array(run * max(len(names), 1) + index[at + length]).dictionary_encode()
        key = pairs.dictionary.to_numpy(zero_copy_only=False)
        before, word = np.divmod(key, max(len(names), 1))
        crc = append_crc(crc[before], added[word], size[word])
        run = pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        runs.append(Runs((crc % np.uint32(buckets)).astype(np.int64), run, at))
    return Features(first, runs)


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, features) over all texts; tasks send their counts, not features."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                for found in features(piece.column("text"), buckets).runs:
                    held = np.bincount(found.run, minlength=len(found.bucket))
                    # sums of a piece are far below 2**53, so they are exact as doubles
                    counts += np.bincount(found.bucket, weights=held, minlength=buckets).astype(np.int64)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    partial = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(build, "bucket bigint, n bigint")
    return partial.groupBy("bucket").agg(F.sum("n").alias("features"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of every bucket from the counts of raw and target texts.

    One number per bucket comes to the driver, however large the tables are.
    """
    held = [dict(map(tuple, counts.collect())) for counts in (raw, target)]
    total = [sum(h.values()) for h in held]

    def gain(bucket: int) -> int:
        s, t = (h.get(bucket, 0) for h in held)
        ratio = (t + 1) * (total[0] + buckets) / ((s + 1) * (total[1] + buckets))
        return math.floor(1000 * math.log(ratio))

    return [gain(b) for b in range(buckets)]


def gumbel(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, from a hash of seed and id (NULL: empty)."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gains: list[int], seed: int = 42) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight and score (weight plus noise)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = np.array(gains, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = features(piece.column("text"), len(gains))
                per_word = np.zeros(found.first[-1] + 1, np.int64)
                for runs in found.runs:
                    # each word begins at most one run of a size
                    per_word[runs.word] += by_bucket[runs.bucket][runs.run]
                weight = np.add.reduceat(per_word, found.first)[:-1] if len(per_word) > 1 else np.zeros(piece.num_rows, np.int64)
                words = np.diff(found.first)
                weight[words == 0] = 0
                noise = np.array([gumbel(i, seed) for i in piece.column("doc_id").to_pylist()], np.int64)
                columns = [words, found.occurrences(), weight, weight + noise]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), *[pa.array(c.astype(np.int64)) for c in columns]],
                    names=["doc_id", "n_words", "n_features", "weight", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(build, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def importance_resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = BUCKETS
) -> DataFrame:
    """Rows ``doc_id, n_words, n_features, weight, score, rank`` of every document.

    ``rank`` is 1, 2, ... for the drawn documents: of those with at least
    ``least_words`` words the highest scores, ``percent`` in a hundred rounded
    down, equal scores by smaller id (NULL first).  It is NULL for all others.
    NULL and empty texts have no features and weight 0; a repeated row is drawn
    for itself; other columns are ignored; an empty target makes all gains
    follow from the raw counts alone.

    Two passes over the texts: bucket counts, then weights.  The weights of all
    documents are stored, sorted by ranges and numbered across them; no task
    sees the whole order.
    """
    gains = bucket_gains(bucket_counts(docs, buckets=buckets), bucket_counts(target, buckets=buckets), buckets)
    scored = stable(
        weigh(docs, gains, seed).withColumn("_may", (F.col("n_words") >= least_words).cast("bigint"))
    )
    wanted = scored.agg(F.coalesce(F.sum("_may"), F.lit(0))).first()[0] * percent // 100
    placed = running_totals(
        scored, [F.col("_may").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first()], {"_place": "_may"}
    )
    drawn = (F.col("_may") == 1) & (F.col("_place") <= wanted)
    return placed.select(
        "doc_id", "n_words", "n_features", "weight", "score", F.when(drawn, F.col("_place")).alias("rank")
    )


def draw(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; ids must be unique."""
    ranked = importance_resample(docs, target, **settings)
    chosen = ranked.where("rank is not null").select(F.col("doc_id").alias("_drawn_id"))
    return docs.join(chosen, docs["doc_id"] == chosen["_drawn_id"], "left_semi")
