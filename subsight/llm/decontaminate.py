"""Benchmark decontamination by embedding edit distance into Hamming distance.

Texts are sequences of words (A-Z lower-cased, punctuation at the edges taken
off); a document leaks an item if some stretch of it is within
``1 - similarity`` edits per item word.  Item-sized windows of the documents
and the items themselves are embedded by shared random walks (at each step the
word under the pointer is put out and a random bit of step and word decides
whether the pointer advances), several times over; tables sample a few steps
of an embedding, and a window that agrees with an item in a table is a
candidate.  Candidates are verified by exact edit distance.

Windows are not laid everywhere: k edits leave at least one of any k + 1 item
words in place, so a window is laid only where one of the k + 1 rarest words
of an item says its start could be.  That loses nothing that verification
would accept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight.llm.text import mix, pieces, span_hashes, words

_U = np.uint64
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


@dataclass(frozen=True)
class LeakRule:
    """``walks`` embeddings with ``tables`` samples of ``sampled`` steps each."""

    similarity: float = 0.8
    walks: int = 6
    tables: int = 8
    sampled: int = 2
    shifts: tuple[int, ...] = (0, -1, 1)
    seed: int = 17
    #: Items whose words go to the executors at once; more go in further passes.
    chunk_bytes: int = 16 << 20

    def allowed(self, length: int) -> int:
        return int((1 - self.similarity) * length + 1e-9)


@dataclass
class Text:
    """Trimmed words; ``first`` bounds words, ``bounds`` bytes by document."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    bounds: np.ndarray


def trimmed_words(column: pa.Array) -> Text:
    w = words(column, hashed=False)
    start, end = w.start.copy(), w.end.copy()
    while True:
        more = np.flatnonzero((start < end) & _PUNCTUATION[w.data[np.minimum(start, len(w.data) - 1)]])
        if not len(more):
            break
        start[more] += 1
    while True:
        more = np.flatnonzero((start < end) & _PUNCTUATION[w.data[np.maximum(end - 1, 0)]])
        if not len(more):
            break
        end[more] -= 1
    kept = start < end
    before = np.concatenate([[0], np.cumsum(kept)])
    start, end = start[kept], end[kept]
    hashes = span_hashes(w.data, start, end) if len(start) else np.zeros(0, np.uint64)
    return Text(hashes, start, end, before[w.first], w.bounds)


class ItemIndex:
    """Everything a task needs to find one chunk of items."""

    _BITS = 20
    _CLASSES = 4096

    def __init__(self, items: Sequence[tuple[int, str]], rule: LeakRule):
        self.rule = rule
        text = trimmed_words(pa.array([t for _, t in items], pa.string()))
        counts = np.diff(text.first)
        self.ids = [items[i][0] for i in range(len(items)) if counts[i]]
        full = np.flatnonzero(counts)
        self.vocabulary = np.unique(text.hash)
        symbols = (np.searchsorted(self.vocabulary, text.hash) + 1).astype(np.int64)
        self.items = [symbols[text.first[i] : text.first[i + 1]] for i in full]
        self.length = counts[full]
        self.flag = np.zeros(1 << self._BITS, bool)
        self.flag[(self.vocabulary >> _U(64 - self._BITS)).astype(np.int64)] = True

        # long words are rare; among them, those that few items have
        spread = np.bincount(np.concatenate([np.unique(s) for s in self.items] or [[0]]), minlength=len(self.vocabulary) + 1)
        size = np.zeros(len(self.vocabulary) + 1, np.int64)
        size[symbols] = text.end - text.start
        anchors = set()
        for item, length in zip(self.items, self.length.tolist()):
            order = sorted(range(length), key=lambda q: (-size[item[q]], spread[item[q]], q))
            anchors.update((int(item[q]), q, length) for q in order[: rule.allowed(length) + 1])
        table = np.array(sorted(anchors), np.int64).reshape(-1, 3)
        self.anchor_at = np.searchsorted(table[:, 0], np.arange(len(self.vocabulary) + 2))
        self.anchor_offset, self.anchor_length = table[:, 1], table[:, 2]

        lengths = np.unique(self.length)
        steps = 2 * int(lengths.max(initial=1))
        draw = np.random.Generator(np.random.PCG64(rule.seed))
        # advance or not, by walk, step and class of the word; words out of the text stop the walk
        self.bits = draw.integers(0, 2, (rule.walks, steps, self._CLASSES), dtype=np.int8)
        self.samples = {int(n): self._sampled_steps(int(n)) for n in lengths}
        keys, owners = [], []
        for n in lengths.tolist():
            own = np.flatnonzero(self.length == n)
            found = self.keys(np.stack([self.items[i] for i in own]))
            keys.append(found.ravel())
            owners.append(np.repeat(own, found.shape[1]))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.key, self.owner = keys[order], (np.concatenate(owners) if owners else np.zeros(0, np.int64))[order]

    def _sampled_steps(self, length: int) -> np.ndarray:
        """(walk, table, sampled) steps within the usual end of a walk."""
        rule = self.rule
        draw = np.random.Generator(np.random.PCG64([rule.seed, length]))
        return draw.integers(0, max(1, 2 * length - 1), (rule.walks, rule.tables, rule.sampled))

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """Table keys by window; 0 where a sampled step has no known word."""
        rule, (count, length) = self.rule, windows.shape
        samples = self.samples[length]
        out = np.empty((count, rule.walks * rule.tables), np.uint64)
        padded = np.concatenate([windows, np.full((count, 1), -1)], axis=1)
        flat, row = padded.ravel(), np.arange(count) * (length + 1)
        kind = (flat % self._CLASSES).astype(np.int16)
        ends = row + length
        for r in range(rule.walks):
            last = int(samples[r].max())
            wanted = set(samples[r].ravel().tolist())
            taken = {}
            pointer = row.copy()
            for j in range(last + 1):
                if j in wanted:
                    taken[j] = flat[pointer]
                pointer += self.bits[r, j][kind[pointer]]
                np.minimum(pointer, ends, out=pointer)
            for t in range(rule.tables):
                seen = np.stack([taken[j] for j in samples[r, t].tolist()])
                with np.errstate(over="ignore"):
                    key = np.full(count, (length << 16) | (r * rule.tables + t) + 1, np.uint64)
                    for part in seen:
                        key = mix(key * _U(0x9E3779B97F4A7C15) + part.view(np.uint64))
                key[(seen == 0).any(axis=0)] = 0
                # past the end of a short walk there is nothing to compare
                key[(seen < 0).all(axis=0)] = 0
                out[:, r * rule.tables + t] = key
        return out

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word in the item vocabulary, 0 if it is not in it."""
        out = np.zeros(len(hashes), np.int64)
        maybe = np.flatnonzero(self.flag[(hashes >> _U(64 - self._BITS)).astype(np.int64)])
        at = np.searchsorted(self.vocabulary, hashes[maybe])
        at = np.minimum(at, len(self.vocabulary) - 1)
        known = self.vocabulary[at] == hashes[maybe]
        out[maybe[known]] = at[known] + 1
        return out

    def find(self, text: Text) -> np.ndarray:
        """Rows (document, item, distance, first word, last word + 1), the best of each pair."""
        none = np.zeros((0, 5), np.int64)
        if not len(text.hash) or not len(self.items):
            return none
        symbols = self.symbols(text.hash)
        hits = np.flatnonzero(symbols)
        hits = hits[self.anchor_at[symbols[hits] + 1] > self.anchor_at[symbols[hits]]]
        many = self.anchor_at[symbols[hits] + 1] - self.anchor_at[symbols[hits]]
        which = np.repeat(self.anchor_at[symbols[hits]], many) + _ranges(many)
        place = np.repeat(hits, many)
        doc = np.searchsorted(text.first, place, side="right") - 1
        known = np.concatenate([[0], np.cumsum(symbols > 0)])
        found = []
        for length in np.unique(self.anchor_length[which]).tolist():
            own = self.anchor_length[which] == length
            starts = place[own] - self.anchor_offset[which[own]]
            spots = np.unique(np.concatenate([np.stack([doc[own], starts + s], axis=1) for s in self.rule.shifts]), axis=0)
            # what could be accepted holds all but k words of an item
            k = self.rule.allowed(length)
            lowest, highest = text.first[spots[:, 0]], text.first[spots[:, 0] + 1]
            inside = known[np.clip(spots[:, 1] + length + k, lowest, highest)]
            inside = inside - known[np.clip(spots[:, 1] - k, lowest, highest)]
            spots = spots[inside >= length - k]
            for lo in range(0, len(spots), 20_000):
                found.append(self._match(symbols, text, spots[lo : lo + 20_000], length))
        rows = np.concatenate(found) if found else none
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        return rows[fresh]

    def _match(self, symbols: np.ndarray, text: Text, spots: np.ndarray, length: int) -> np.ndarray:
        doc, start = spots[:, 0], spots[:, 1]
        lo, hi = text.first[doc], text.first[doc + 1]
        windows = _cut(symbols, start, length, lo, hi)
        keys = self.keys(windows)
        left, right = np.searchsorted(self.key, keys, "left"), np.searchsorted(self.key, keys, "right")
        many = np.where(keys == 0, 0, right - left)
        window = np.repeat(np.repeat(np.arange(len(spots)), keys.shape[1]), many.ravel())
        item = self.owner[np.repeat(left.ravel(), many.ravel()) + _ranges(many.ravel())]
        pairs = np.unique(np.stack([window, item], axis=1), axis=0)
        # tables of windows of one length hold items of that length only
        pairs = pairs[self.length[pairs[:, 1]] == length] if len(pairs) else pairs
        if not len(pairs):
            return np.zeros((0, 5), np.int64)
        k = self.rule.allowed(length)
        window, item = pairs[:, 0], pairs[:, 1]
        from_ = start[window] - k
        regions = _cut(symbols, from_, length + 2 * k, lo[window], hi[window])
        distance, begin, end = best_stretch(np.stack([self.items[i] for i in item]), regions)
        near = distance <= k
        rows = np.stack([doc[window], item, distance, from_ + begin, from_ + end], axis=1)[near]
        return rows


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. c - 1 for each count c, in a row."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _cut(symbols: np.ndarray, start: np.ndarray, length: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Windows of symbols; places outside the document are unknown words."""
    at = start[:, None] + np.arange(length)
    inside = (at >= lo[:, None]) & (at < hi[:, None])
    return np.where(inside, symbols[np.clip(at, 0, len(symbols) - 1)], 0)


def best_stretch(items: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edit distance of each item to a stretch of its region, and its bounds.

    One row of the dynamic programme at a time, for all pairs; the stretch may
    begin and end anywhere.  The begin is carried along as part of the value.
    """
    count, width = regions.shape
    scale = width + 1
    column = np.arange(width + 1)
    # value = distance * scale + begin: smaller distances win, then earlier begins
    row = np.broadcast_to(column, (count, width + 1)).copy()
    for i in range(items.shape[1]):
        differ = (regions != items[:, i : i + 1]) * scale
        new = row + scale
        new[:, 1:] = np.minimum(new[:, 1:], row[:, :-1] + differ)
        # one more region word costs an edit: running minimum with that slope
        slope = column * scale
        row = np.minimum.accumulate(new - slope, axis=1) + slope
    end = row.argmin(axis=1)
    value = row[np.arange(count), end]
    return value // scale, value % scale, end


def _items_in_chunks(benchmark: DataFrame, id_column: str, text: str, rule: LeakRule) -> Iterator[list[tuple[int, str]]]:
    """Chunks of items of bounded size, the same ones on every run."""
    usable = benchmark.where(F.col(id_column).isNotNull() & (F.length(text) > 0))
    usable = usable.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).cast("string").alias("text")).distinct()
    size = usable.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = -(-size // rule.chunk_bytes) or 1
    for chunk in range(chunks):
        part = usable if chunks == 1 else usable.where(F.pmod(F.xxhash64("id"), F.lit(chunks)) == chunk)
        yield sorted((r.id, r.text) for r in part.collect())


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rule: LeakRule = LeakRule(),
) -> DataFrame:
    """A row per document and item it leaks: ids, distance in words,
    similarity, and the code points ``start`` to ``end`` of the closest stretch.

    One scan of the documents per chunk of items, no shuffle of texts.  NULL
    and blank texts and items match nothing; items under 1 / (1 - similarity)
    words match exactly or not at all.  Repeated documents and items give
    their rows once; an empty table on either side gives no rows.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = "doc_id bigint, item_id bigint, distance bigint, similarity double, start bigint, end bigint"
    result = None
    for items in _items_in_chunks(benchmark, item_id, item_text, rule):
        shared = docs.sparkSession.sparkContext.broadcast(ItemIndex(items, rule))

        def build(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for piece in pieces(batch):
                    column = piece.column("text")
                    split = trimmed_words(column)
                    found = index.find(split)
                    if not len(found):
                        continue
                    doc, item = found[:, 0], found[:, 1]
                    distance, length = found[:, 2], index.length[item]
                    spans = [
                        _characters(column[int(d)].as_py(), split, int(d), int(a), int(b))
                        for d, a, b in zip(doc, found[:, 3], found[:, 4])
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            piece.column("doc_id").take(pa.array(doc)),
                            pa.array([index.ids[i] for i in item], pa.int64()),
                            pa.array(distance),
                            pa.array(1 - distance / length),
                            pa.array([s for s, _ in spans], pa.int64()),
                            pa.array([e for _, e in spans], pa.int64()),
                        ],
                        names=["doc_id", "item_id", "distance", "similarity", "start", "end"],
                    )

        part = rows.mapInArrow(build, schema)
        result = part if result is None else result.union(part)
    best = F.min_by(F.struct("distance", "similarity", "start", "end"), F.struct("distance", "start", "end")).alias("best")
    return result.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def _characters(text: str, split: Text, doc: int, first: int, last: int) -> tuple[int, int]:
    """Code points of a stretch of words."""
    first, last = max(first, int(split.first[doc])), min(last, int(split.first[doc + 1]))
    raw = text.encode()
    base = int(split.bounds[doc])
    begin, end = int(split.start[first]) - base, int(split.end[last - 1]) - base
    return len(raw[:begin].decode("utf-8", "ignore")), len(raw[:end].decode("utf-8", "ignore"))


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", rule: LeakRule = LeakRule(), item_id: str = "item_id"
) -> DataFrame:
    """The rows, with all columns, that leak no item; NULL texts stay."""
    columns = docs.columns
    at = columns.index(text)
    kept = docs
    for items in _items_in_chunks(benchmark, item_id, "text", rule):
        shared = docs.sparkSession.sparkContext.broadcast(ItemIndex(items, rule))

        def build(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, text):
                    clean = np.ones(piece.num_rows, bool)
                    clean[shared.value.find(trimmed_words(piece.column(at)))[:, 0]] = False
                    yield piece.filter(pa.array(clean))

        kept = kept.mapInArrow(build, docs.schema)
    return kept
