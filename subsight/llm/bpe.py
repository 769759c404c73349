"""Byte-level BPE with a hierarchical-bitmap rank queue.

All distinct pre-tokens of a batch stand in one doubly linked list of symbols,
with a gap after each pre-token.  Buckets, one per merge rank, hold list
positions whose pair has that rank; a bitmap of three levels finds the lowest
non-empty bucket by find-first-set.  Everything in a bucket is merged at once;
entries whose pair has changed since they were queued are stale and skipped.

Taking a rank for all pre-tokens at once is exact because pre-tokens do not
interact and a rank that is lowest over all is lowest in each that has it.
Within one pre-token the leftmost of several pairs comes first.  A merge may
create a pair of lower rank, which must then come before the other pairs of
the same bucket; ranks for which a vocabulary allows that are known from its
splits, and only one pair per pre-token is merged at a time for them.  The
others wait in a heap per pre-token, so each is taken up once more and long
pre-tokens take time in proportion to their length, but for a logarithm.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsight.llm.text import pieces

_NONE = np.int64(-1)
_LEVEL = 6


class RankBitmap:
    """Set of small integers with find-first-set over levels of 64-bit words."""

    def __init__(self, size: int):
        self.levels = []
        while True:
            size = (size + 63) >> _LEVEL
            self.levels.append([0] * size)
            if size == 1:
                break

    def add(self, value: int) -> None:
        for level in self.levels:
            word, bit = value >> _LEVEL, 1 << (value & 63)
            if level[word] & bit:
                return
            level[word] |= bit
            value = word

    def remove(self, value: int) -> None:
        for level in self.levels:
            value, bit = value >> _LEVEL, 1 << (value & 63)
            level[value] &= ~bit
            if level[value]:
                return

    def first(self) -> int:
        """Smallest member, -1 if there is none."""
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            if not word:
                return -1
            at = (at << _LEVEL) | ((word & -word).bit_length() - 1)
        return at


class Vocabulary:
    """Ranks of byte strings, with the pairs that merge into each of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        self.bytes_of = [b""] * self.size
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs, merged, late = [], [], set()
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if left is None or right is None:
                    continue
                pairs.append(left << 32 | right)
                merged.append(rank)
                late.update(part for part in (left, right) if part > rank)
        order = np.argsort(np.array(pairs, np.int64))
        self.pairs = np.array(pairs, np.int64)[order]
        self.merged = np.array(merged, np.int64)[order]
        self.late = late

    @classmethod
    def read(cls, lines: bytes) -> Vocabulary:
        """From lines of ``base64 rank``."""
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a})

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it does not merge."""
        if not len(self.pairs):
            return np.full(len(left), _NONE)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.merged[at], _NONE)

    def encode_all(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and their bounds."""
        lengths = np.array([len(t) for t in texts], np.int64)
        # one position after each text holds no symbol
        bounds = np.concatenate([[0], np.cumsum(lengths + 1)])
        size = int(bounds[-1])
        symbol = np.full(size, _NONE)
        inside = np.ones(size, bool)
        inside[bounds[1:] - 1] = False
        symbol[inside] = self.single[np.frombuffer(b"".join(texts), np.uint8)]
        text_of = np.repeat(np.arange(len(texts)), lengths + 1)
        after = np.arange(1, size + 1)
        before = np.arange(-1, size - 1)
        self._merge(symbol, before, after, text_of)
        live = np.flatnonzero(symbol >= 0)
        return symbol[live], np.searchsorted(live, bounds)

    def _merge(self, symbol, before, after, text_of) -> None:
        """Merge in place; a symbol that was taken by its left neighbour becomes -1."""
        buckets: dict[int, list[np.ndarray]] = {}
        waiting: dict[int, dict[int, list[int]]] = {}
        queue = RankBitmap(self.size)

        def put(at: np.ndarray, ranks: np.ndarray) -> None:
            if len(at) == 1:
                if ranks[0] >= 0:
                    buckets.setdefault(int(ranks[0]), []).append(at)
                    queue.add(int(ranks[0]))
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            begin = int(np.searchsorted(ranks, 0))
            cuts = np.flatnonzero(np.diff(ranks[begin:])) + begin + 1
            if begin < len(at):
                edges = [begin, *cuts.tolist(), len(at)]
                for lo, hi, rank in zip(edges, edges[1:], ranks[edges[:-1]].tolist()):
                    buckets.setdefault(rank, []).append(at[lo:hi])
                    queue.add(rank)

        left = np.flatnonzero((symbol[:-1] >= 0) & (symbol[1:] >= 0))
        put(left, self.lookup(symbol[left], symbol[left + 1]))
        while (rank := queue.first()) >= 0:
            queue.remove(rank)
            held = buckets.pop(rank, [])
            heaps = waiting.get(rank)
            if heaps:
                held = _leftmost_waiting(heaps, held, text_of)
            at = np.sort(held[0] if len(held) == 1 else np.concatenate(held))
            at = at[symbol[at] >= 0]
            right = after[at]
            fresh = self.lookup(symbol[at], symbol[right]) == rank
            fresh[1:] &= at[1:] != at[:-1]
            at, right = at[fresh], right[fresh]
            if rank in self.late:
                first = np.ones(len(at), bool)
                first[1:] = text_of[at[1:]] != text_of[at[:-1]]
                if not first.all():
                    heaps = waiting.setdefault(rank, {})
                    rest = at[~first]
                    for text, place in zip(text_of[rest].tolist(), rest.tolist()):
                        heappush(heaps.setdefault(text, []), place)
                if waiting.get(rank):
                    queue.add(rank)
                at, right = at[first], right[first]
            elif len(at) > 1:
                at, right = _leftmost(at, right)
            if not len(at):
                continue
            symbol[at], symbol[right] = rank, _NONE
            beyond = after[right]
            after[at], before[beyond] = beyond, at
            previous = before[at]
            changed = np.concatenate([at, previous[previous >= 0]])
            changed = changed[symbol[changed] >= 0]
            follow = after[changed]
            open_ = symbol[follow] >= 0
            changed, follow = changed[open_], follow[open_]
            if len(changed):
                put(changed, self.lookup(symbol[changed], symbol[follow]))

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


def _leftmost_waiting(
    heaps: dict[int, list[int]], held: list[np.ndarray], text_of: np.ndarray
) -> list[np.ndarray]:
    """Of pre-tokens with waiting places the leftmost, with new places of all others."""
    new = np.concatenate(held) if held else np.zeros(0, np.int64)
    alone = np.ones(len(new), bool)
    for n, (text, place) in enumerate(zip(text_of[new].tolist(), new.tolist())):
        if text in heaps:
            heappush(heaps[text], place)
            alone[n] = False
    tops = []
    for text in list(heaps):
        tops.append(heappop(heaps[text]))
        if not heaps[text]:
            del heaps[text]
    return [new[alone], np.array(tops, np.int64)]


def _leftmost(at: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of chains of overlapping pairs (a a a) the first, third, ... pair."""
    chained = np.zeros(len(at), bool)
    chained[1:] = at[1:] == right[:-1]
    if not chained.any():
        return at, right
    index = np.arange(len(at))
    head = np.maximum.accumulate(np.where(chained, 0, index))
    kept = (index - head) % 2 == 0
    return at[kept], right[kept]


class Encoder:
    """Encodes texts; results of pre-tokens are kept within a byte bound."""

    #: Bytes of distinct pre-tokens encoded together, and kept for later texts.
    BATCH_BYTES = 1 << 20
    KEPT_BYTES = 6 << 20

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        self.ids: dict[str, str] = {}
        self.held = 0
        self.bytes_of = {str(i): b for i, b in enumerate(vocabulary.bytes_of)}

    def joined_ids(self, texts: Sequence[str]) -> list[str]:
        """Decimal ids of every text, joined by commas."""
        out, parts, fresh, size = [], [], {}, 0
        for text in texts:
            tokens = self.split(text)
            parts.append(tokens)
            for token in set(tokens).difference(self.ids):
                if token not in fresh:
                    fresh[token] = None
                    size += len(token)
            if size > self.BATCH_BYTES:
                self._flush(parts, fresh, out)
                parts, fresh, size = [], {}, 0
        self._flush(parts, fresh, out)
        return out

    def _flush(self, parts: list[list[str]], fresh: dict[str, None], out: list[str]) -> None:
        names = list(fresh)
        if names:
            raw = [n.encode() for n in names]
            ids, bounds = self.vocabulary.encode_all(raw)
            texts, edges = list(map(str, ids.tolist())), bounds.tolist()
            self.ids.update((n, ",".join(texts[a:b])) for n, a, b in zip(names, edges, edges[1:]))
            self.held += sum(map(len, raw))
        find = self.ids.__getitem__
        out += [",".join(map(find, tokens)) for tokens in parts]
        if self.held > self.KEPT_BYTES:
            self.ids, self.held = {}, 0

    def decode(self, joined: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, joined.split(","))) if joined else b""


def encode_documents(
    docs: DataFrame, ranks: bytes, pattern: str, id_column: str = "doc_id", text: str = "text", ids: bool = True
) -> DataFrame:
    """Per row: doc_id, n_tokens, digests of ids and decoded bytes, and the ids.

    ``ranks`` is the content of a rank file; it goes to the executors with the
    function, once per stage.  NULL and empty texts have no ids and decode to
    nothing.  No shuffle; rows stay as they are, other columns are left out.
    """
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_vocabulary(shared.value), pattern)
        sha = hashlib.sha256
        for batch in batches:
            for piece in pieces(batch, text):
                joined = encoder.joined_ids([t or "" for t in piece.column(text).to_pylist()])
                columns = [
                    piece.column(id_column),
                    pa.array([j.count(",") + 1 if j else 0 for j in joined], pa.int64()),
                    pa.array([sha(j.encode()).hexdigest() for j in joined]),
                    pa.array([sha(encoder.decode(j)).hexdigest() for j in joined]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    flat = np.fromstring(",".join(filter(None, joined)), np.int32, sep=",")
                    bounds = np.concatenate([[0], np.cumsum(columns[1].to_numpy())]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias(id_column), F.col(f"`{text}`").cast("string").alias(text))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(build, schema + (", ids array<int>" if ids else ""))


_READ: dict[int, Vocabulary] = {}


def _vocabulary(lines: bytes) -> Vocabulary:
    """Parsed once per worker process, which serves many tasks."""
    key = hash(lines)
    if key not in _READ:
        _READ.clear()
        _READ[key] = Vocabulary.read(lines)
    return _READ[key]


def decode_documents(encoded: DataFrame, ranks: bytes, ids: str = "ids", out: str = "text") -> DataFrame:
    """Add the text of an array of ids; bytes that are not UTF-8 become U+FFFD."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    columns = [c for c in encoded.columns if c != out]
    kept = encoded.select(*[f"`{c}`" for c in columns])
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared.value)
        for batch in batches:
            texts = [
                None if i is None else vocabulary.decode(i).decode("utf-8", "replace")
                for i in batch.column(ids).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*columns, out])

    return kept.mapInArrow(build, schema)
