"""Language-model scores from a hierarchical Pitman-Yor process.

Each context is a restaurant: customers are the words seen in it, tables are
served words drawn from the parent restaurant, whose customers they are in
turn.  Every previous word is a context of its own; its parent is the class of
the previous word (by its last two bytes); the parent of all classes is the
root, whose base gives most of its mass to the one symbol for unseen words.

Seating is sampled by Gibbs: the customers of one word in one restaurant are
taken out, with their tables in the parent, and seated again by the Chinese
restaurant rule.  Given the totals of the restaurants words do not depend on
each other, so the work is dealt out by word.  Totals of the classes and of
frequent contexts are bounded in number and sent to all tasks; those of all
other contexts are summed where the context is dealt to, and each part gets
back what it asks for.  After each round the totals are summed up anew; in the
last one predictive probabilities are averaged over sweeps.

A frequent word has far too many customers for one part: in frequent contexts
it has a bounded table of probabilities, which goes back to a scan of the
texts; in all others it is seated with the context, below the frequent word's
own class restaurants.  Only sums per document come back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsight.llm.passages import _packed as packed
from subsight.llm.passages import _steps as steps
from subsight.llm.passages import _summed as summed
from subsight.llm.passages import _unpacked as unpacked
from subsight.llm.storage import settled
from subsight.llm.text import mix, pieces, words
from subsight.session import stable

_U = np.uint64
_END = _U(0x51E7B1D2C3A49687)


@dataclass(frozen=True)
class LmRule:
    """Bounds of the contexts, and the process's discounts and strengths.

    ``frequent`` is the number of words with a probability table of their own,
    ``classes`` the number of parents that the contexts, one for each word,
    share.  ``tokens_per_part`` bounds what one task holds.
    """

    frequent: int = 1023
    classes: int = 256
    discount: tuple[float, float, float] = (0.75, 0.8, 0.75)  # root, class, word
    strength: tuple[float, float, float] = (100.0, 30.0, 5.0)
    unseen: float = 0.9
    rounds: int = 1
    burn_in: int = 2
    samples: int = 3
    tokens_per_part: int = 1_500_000
    seed: int = 23

    @property
    def contexts(self) -> int:
        return self.classes + self.frequent + 2


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


# --- tokens -----------------------------------------------------------------


@dataclass
class Tokens:
    """Words and one end per document, with the classes of their last bytes."""

    hash: np.ndarray
    kind: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def tokens(column: pa.Array, classes: int) -> Tokens:
    w = words(column)
    counts = np.diff(w.first) + 1
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.full(first[-1], _END)
    kind = np.zeros(first[-1], np.int64)
    inside = np.ones(first[-1], bool)
    inside[first[1:] - 1] = False
    out[inside] = w.hash
    if len(w.start):
        last = w.data[w.end - 1].astype(np.int64)
        before = np.where(w.end - 2 >= w.start, w.data[np.maximum(w.end - 2, 0)], 0).astype(np.int64)
        kind[inside] = 1 + (last * 31 + before * 7) % (classes - 1)
    return Tokens(out, kind, np.repeat(np.arange(len(counts)), counts), first)


class Frequent:
    """Numbers 1.. of the frequent words, 0 for all others; the end is 1."""

    def __init__(self, hashes: list[int]):
        known = np.array([h for h in hashes if _U(h & (2**64 - 1)) != _END], np.int64).view(np.uint64)
        self.hash = np.sort(np.append(known, _END))
        self.number = np.where(self.hash == _END, 1, 0)
        self.number[self.hash != _END] = np.arange(2, len(self.hash) + 1)
        self.flag = np.zeros(1 << 16, bool)
        self.flag[(self.hash >> _U(48)).astype(np.int64)] = True

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int64)
        maybe = np.flatnonzero(self.flag[(hashes >> _U(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hash, hashes[maybe]), len(self.hash) - 1)
        hit = self.hash[at] == hashes[maybe]
        out[maybe[hit]] = self.number[at[hit]]
        return out


#: Words that have a number to travel by, and bits of the hash that find it.
_NUMBERED, _SLOT_BITS = 1 << 16, 21
_HASHED = _U(1 << 63)


class Ids:
    """Numbers of common words, the frequent ones first; other words go by class and hash.

    A number says nothing about a word that its hash does not: it is shorter.
    """

    def __init__(self, known: Frequent, more: list[tuple[int, int]], rule: LmRule):
        """``more``: hashes and classes of the next words."""
        self.known, self.last = known, len(known.hash)
        self.class_shift = _U(63 - max(1, (rule.classes - 1).bit_length()))
        hashes = np.array([h for h, _ in more], np.int64).view(np.uint64)
        self.hash = np.concatenate([[_U(0)], known.hash[np.argsort(known.number)], hashes])
        self.kind = np.concatenate([np.zeros(self.last + 1, np.int64), np.array([k for _, k in more], np.int64)])
        self.table = np.zeros(1 << _SLOT_BITS, np.int32)
        # of words that meet in a slot one has its number there
        self.table[self._slot(self.hash[:0:-1])] = np.arange(len(self.hash) - 1, 0, -1)

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> _U(64 - _SLOT_BITS)).astype(np.int64)

    def of(self, t: Tokens) -> np.ndarray:
        at = self.table[self._slot(t.hash)]
        out = at.astype(np.uint64)
        rest = np.flatnonzero((self.hash[at] != t.hash) | (at == 0))
        hashes = t.hash[rest]
        number = self.known.of(hashes).astype(np.uint64)
        own = _HASHED | t.kind[rest].astype(np.uint64) << self.class_shift | hashes & ((_U(1) << self.class_shift) - _U(1))
        out[rest] = np.where(number > 0, number, own)
        return out

    def kinds(self, ids: np.ndarray) -> np.ndarray:
        """Classes of words that are not frequent."""
        hashed = ids >= _HASHED
        of_hash = ((ids & ~_HASHED) >> self.class_shift).astype(np.int64)
        return np.where(hashed, of_hash, self.kind[np.where(hashed, _U(0), ids).astype(np.int64)])


# --- seating ----------------------------------------------------------------


@dataclass
class Totals:
    """Customers and tables of all restaurants; the last one is the root.

    ``rare_customers`` and ``rare_tables``: of the contexts of words that are
    not frequent, as far as a part has them.
    """

    customers: np.ndarray
    tables: np.ndarray
    rare_customers: np.ndarray
    rare_tables: np.ndarray

    @classmethod
    def empty(cls, rule: LmRule, rare: int = 0) -> Totals:
        many = rule.contexts + rule.classes + 1
        return cls(np.zeros(many), np.zeros(many), np.zeros(rare), np.zeros(rare))

    def in_context(self, context: np.ndarray, rule: LmRule) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of contexts, those of a part behind the bounded ones."""
        n = rule.contexts
        both = ((self.customers, self.rare_customers), (self.tables, self.rare_tables))
        return tuple(np.concatenate([a[:n], b])[context] for a, b in both)


def seat(count, attract, discount: float, draw) -> np.ndarray:
    """Tables of ``count`` customers; ``attract`` is the weight of a new table.

    One customer after the other at first, then in groups of a quarter of
    those seated, whose number of new tables is binomial.
    """
    count = count.astype(np.int64)
    tables = np.minimum(count, 1)
    open_ = np.flatnonzero(count > 1)
    done = np.ones(len(open_), np.int64)
    while len(open_):
        group = np.minimum(np.maximum(1, done // 4), count[open_] - done)
        weight = attract[open_]
        chance = weight / (weight + np.maximum(done - discount * tables[open_], 1e-9))
        tables[open_] += draw.binomial(group, np.clip(chance, 0.0, 1.0))
        done += group
        more = done < count[open_]
        open_, done = open_[more], done[more]
    return tables


class Seating:
    """Restaurants of a set of words: one entry per word and context."""

    def __init__(self, word: np.ndarray, context: np.ndarray, count: np.ndarray, parent: np.ndarray, rule: LmRule):
        """``word`` from 0, ``parent`` the class of each context; more contexts than the rule's are a part's own."""
        self.rule, self.words, self.width = rule, int(word.max(initial=-1)) + 1, len(parent)
        c = rule.classes
        leaf = context >= c
        self.word, self.context, self.count = word[leaf], context[leaf], count[leaf]
        nodes = np.concatenate([word[leaf] * c + parent[context[leaf]], word[~leaf] * c + context[~leaf]])
        self.node, at = np.unique(nodes, return_inverse=True)
        self.up = at[: int(leaf.sum())]
        self.direct = np.bincount(at[int(leaf.sum()) :], count[~leaf], minlength=len(self.node))
        self.node_word, self.node_class = self.node // c, self.node % c
        self.leaf_tables = np.minimum(self.count, 1)
        #: a single customer has a table, whatever the draw
        self.several = np.flatnonzero(self.count > 1)
        self._gather()
        self.node_tables = np.minimum(self.node_count, 1).astype(np.int64)
        self.root_count = np.bincount(self.node_word, self.node_tables, minlength=self.words)
        self.root_tables = np.minimum(self.root_count, 1).astype(np.int64)

    def _gather(self) -> None:
        self.node_count = self.direct + np.bincount(self.up, self.leaf_tables, minlength=len(self.node))

    def totals(self) -> Totals:
        rule, out = self.rule, Totals.empty(self.rule)
        n, c = rule.contexts, rule.classes
        customers = np.bincount(self.context, self.count, minlength=self.width)
        tables = np.bincount(self.context, self.leaf_tables, minlength=self.width)
        out.customers[:n], out.rare_customers = customers[:n], customers[n:]
        out.tables[:n], out.rare_tables = tables[:n], tables[n:]
        out.customers[n : n + c] = np.bincount(self.node_class, self.node_count, minlength=c)
        out.tables[n : n + c] = np.bincount(self.node_class, self.node_tables, minlength=c)
        out.customers[-1], out.tables[-1] = self.root_count.sum(), self.root_tables.sum()
        return out

    def sweep(self, totals: Totals, base: float, draw) -> None:
        """Seat every word of every restaurant again, leaves first."""
        rule = self.rule
        (d0, d1, d2), (s0, s1, s2) = rule.discount, rule.strength
        n, c = rule.contexts, rule.classes
        own = self.several
        node, word = self.up[own], self.word[own]
        pull0, size0 = s0 + d0 * totals.tables[-1], s0 + totals.customers[-1]
        pull, size = s1 + d1 * totals.tables[n : n + c], s1 + totals.customers[n : n + c]

        root = self._served(self.root_count, self.root_tables, d0, pull0 * base, size0)
        # the parent as it is without the tables of the restaurant at hand
        left = self.node_count[node] - self.leaf_tables[own]
        kind = self.node_class[node]
        parent = self._served(left, np.minimum(self.node_tables[node], left), d1, pull[kind] * root[word], size[kind])
        pull2 = s2 + d2 * totals.in_context(self.context[own], rule)[1]
        self.leaf_tables[own] = seat(self.count[own], pull2 * parent, d2, draw)
        self._gather()
        own = np.flatnonzero(self.node_count > 1)
        word = self.node_word[own]
        left = self.root_count[word] - self.node_tables[own]
        grand = self._served(left, np.minimum(self.root_tables[word], left), d0, pull0 * base, size0)
        self.node_tables = np.minimum(self.node_count, 1).astype(np.int64)
        self.node_tables[own] = seat(self.node_count[own], pull[self.node_class[own]] * grand, d1, draw)
        self.root_count = np.bincount(self.node_word, self.node_tables, minlength=self.words)
        self.root_tables = seat(self.root_count, np.full(self.words, pull0 * base), d0, draw)

    @staticmethod
    def _served(count, tables, discount, fresh, size):
        return (np.maximum(count - discount * tables, 0.0) + fresh) / size


class Predictor:
    """Averaged discounted counts of some words, and probabilities from them.

    ``totals`` hold for the sweeps.  Probabilities of all words add up to one
    with the averages of the totals over the same sweeps: ``average`` has the
    sums over all parts, by default those of this one alone.
    """

    def __init__(self, seating: Seating, totals: Totals, base: float, draw, average: Totals | None = None):
        rule = seating.rule
        self.s, self.base, self.average = seating, base, Totals.empty(rule, seating.width - rule.contexts)
        self.totals = average or self.average
        d0, d1, d2 = rule.discount
        self.leaf, self.node, self.root = (np.zeros(len(x)) for x in (seating.count, seating.node, seating.root_count))
        for i in range(rule.burn_in + rule.samples):
            seating.sweep(totals, base, draw)
            if i >= rule.burn_in:
                self.leaf += (seating.count - d2 * seating.leaf_tables) / rule.samples
                self.node += (seating.node_count - d1 * seating.node_tables) / rule.samples
                self.root += (seating.root_count - d0 * seating.root_tables) / rule.samples
                now = seating.totals()
                for name in ("customers", "tables", "rare_customers", "rare_tables"):
                    getattr(self.average, name).__iadd__(getattr(now, name) / rule.samples)
        self.leaf_key = seating.word * seating.width + seating.context
        order = np.argsort(self.leaf_key)
        self.leaf_key, self.leaf = self.leaf_key[order], self.leaf[order]

    def probability(self, word: np.ndarray, context: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """P(word | context); a word of -1 was never seen."""
        rule, totals = self.s.rule, self.totals
        (d0, d1, d2), (s0, s1, s2) = rule.discount, rule.strength
        n, c = rule.contexts, rule.classes
        seen = word >= 0
        at = np.where(seen, word, 0)
        start = np.where(seen, self.base, rule.unseen)
        root = np.where(seen, self.root[at] if len(self.root) else 0.0, 0.0)
        p = (root + (s0 + d0 * totals.tables[-1]) * start) / (s0 + totals.customers[-1])
        kind = np.where(context >= c, parent[context], context)
        own = _find(self.s.node, self.node, word * c + kind, seen)
        p = (own + (s1 + d1 * totals.tables[n + kind]) * p) / (s1 + totals.customers[n + kind])
        own = _find(self.leaf_key, self.leaf, word * self.s.width + context, seen)
        customers, tables = totals.in_context(context, rule)
        leaf = (own + (s2 + d2 * tables) * p) / (s2 + customers)
        return np.where(context >= c, leaf, p)


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, seen: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(seen & (keys[at] == wanted), values[at], 0.0)


# --- counts dealt out by word, or by context, with the documents that ask for them ------

_ROWS = "part int, kind int, block bigint, a binary, b binary, c binary, d binary, e binary, f binary"
#: Kinds of rows: counts of a word by context, of a rare context by frequent word; who asks
#: for them; the ids of a piece's documents; counts of frequent words in frequent contexts;
#: the rare contexts of a part, as they are asked for: by owner, then by id.
_WORD, _CONTEXT, _WORD_ASKED, _CONTEXT_ASKED, _IDS, _FREQUENT, _NAMES = range(7)
#: Rows of a round: tables by rare context, and their sums as asked for; totals of bounded
#: restaurants; tables of frequent words in rare contexts, by class; restaurants of frequent words.
_UP, _DOWN, _LAST, _TOTALS, _GUESTS, _STATE = range(7, 13)

#: Parts for the counts of the frequent words.
FREQUENT_PARTS = 16


def _table(rows: list[tuple]) -> pa.RecordBatch:
    """Rows whose last columns may be missing."""
    names, kinds = zip(*(f.split() for f in _ROWS.split(", ")))
    types = [{"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[k] for k in kinds]
    columns = zip(*((*r, *[None] * (len(names) - len(r))) for r in rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))


def _numbers(data: bytes) -> np.ndarray:
    return unpacked(data).view(np.int64)


def _owner(ids: np.ndarray, parts: int) -> np.ndarray:
    return (mix(ids) % _U(parts)).astype(np.int64)


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before."""
    fresh = np.ones(len(columns[0]), bool)
    fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return fresh


def _blocks(rows: DataFrame, sent, rule: LmRule, parts: int) -> DataFrame:
    """Counts of pairs of words, by one piece of the texts and one part.

    A pair of a word and its context goes by the word, or by the context where
    only that is not frequent.  Next to the training count are the number of
    tokens that ask for the pair and the number in its piece of each of their
    documents.  Pairs of two frequent words are counted and have no askers.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, number = sent.value, 0
        last = ids.last
        common = np.zeros((last + 1) ** 2, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text", 8 << 20):
                block = TaskContext.get().partitionId() << 16 | number
                number += 1
                t = tokens(piece.column("text"), rule.classes)
                word = ids.of(t)
                context = np.empty_like(word)
                context[1:] = word[:-1]
                # texts begin after an end
                context[t.first[:-1]] = 1
                trained = ~np.asarray(piece.column("held"))[t.doc]
                usual, known = word <= last, context <= last
                own = usual & known & trained
                common += np.bincount((word[own] * _U(last + 1) + context[own]).astype(np.int64), minlength=len(common))
                found = []
                for kind, chosen, key, other in ((_WORD, ~usual, word, context), (_CONTEXT, usual & ~known, context, word)):
                    at = np.flatnonzero(chosen)
                    if len(at):
                        found += _dealt(kind, block, key[at], other[at], trained[at], t.doc[at], parts)
                held = [np.asarray(piece.column("doc_id").fill_null(0)), *(np.asarray(piece.column(c)) for c in ("nothing", "crc"))]
                found.append((block % parts, _IDS, block, *(np.ascontiguousarray(x).tobytes() for x in held)))
                yield _table(found)
        used = np.flatnonzero(common)
        word, context = np.divmod(used, last + 1)
        found = []
        for p in range(FREQUENT_PARTS):
            own = word % FREQUENT_PARTS == p
            if own.any():
                found.append((parts + p, _FREQUENT, 0, steps(word[own]), packed(context[own]), packed(common[used[own]])))
        if found:
            yield _table(found)

    return rows.mapInArrow(build, _ROWS)


def _dealt(kind: int, block: int, key, other, trained, doc, parts: int) -> list[tuple]:
    part = _owner(key, parts).astype(np.uint16 if parts < 1 << 16 else np.int64)
    order = np.lexsort((other, key, part))
    part, key, other, trained, doc = part[order], key[order], other[order], trained[order], doc[order]
    head = np.flatnonzero(_heads(key, other))
    asked = np.diff(np.append(head, len(key)))
    learned = np.add.reduceat(trained.astype(np.int64), head)
    part, key, other, tail = part[head], key[head], other[head], np.append(head, len(key))
    opens = np.flatnonzero(_heads(key))
    many, names = np.diff(np.append(opens, len(key))), key[opens]
    here = np.unique(part)
    cuts, name_cuts = (np.append(np.searchsorted(p, here), len(p)) for p in (part, part[opens]))
    return [
        (
            int(p), kind, block, packed(names[name_cuts[i] : name_cuts[i + 1]]), packed(many[name_cuts[i] : name_cuts[i + 1]]),
            packed(other[a:b]), packed(learned[a:b]), packed(asked[a:b]), packed(doc[tail[a] : tail[b]]),
        )
        for i, (p, a, b) in enumerate(zip(here, cuts[:-1], cuts[1:]))
    ]


def _by_part(batches: Iterator[pa.RecordBatch], key: str = "part") -> Iterator[tuple[int, list[dict]]]:
    """Rows of one part together; they follow each other."""
    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row[key] != at:
                if held:
                    yield at, held
                at, held = row[key], []
            held.append(row)
    if held:
        yield at, held


def _gathered(df: DataFrame, parts: int) -> DataFrame:
    return df.repartition(parts, "part").sortWithinPartitions("part")


def _merged(blocks: DataFrame, sent, parts: int) -> DataFrame:
    """Counts of a part's pairs over all pieces, and which of them each piece asks for.

    Rare contexts go by their place among the part's, words that are dealt by nothing but their order.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = _U(sent.value.last)
        for part, held in _by_part(batches):
            found = [tuple(r.values()) for r in held if r["kind"] not in (_WORD, _CONTEXT)]
            if len(found) < len(held):
                _, many, context, trained = merged(part, _WORD, held, found)
                guest, guest_many, guest_word, guest_trained = merged(part, _CONTEXT, held, found)
                rare = context > last
                names, at = np.unique(np.concatenate([context[rare], guest]), return_inverse=True)
                order = np.argsort(_owner(names, parts), kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                own, guests = np.split(place[at], [int(rare.sum())])
                context[rare] = last + _U(1) + own.astype(np.uint64)
                found += [
                    (part, _WORD, 0, b"", packed(many), packed(context), packed(trained)),
                    (part, _CONTEXT, 0, steps(guests), packed(guest_many), packed(guest_word), packed(guest_trained)),
                    (part, _NAMES, 0, steps(names[order])),
                ]
            yield _table(found)

    def merged(part, kind, held, found):
        own = [r for r in held if r["kind"] == kind]
        if not own:
            none = np.zeros(0, np.uint64)
            return none, none.view(np.int64), none, none.view(np.int64)
        key = np.concatenate([np.repeat(unpacked(r["a"]), _numbers(r["b"])) for r in own])
        sizes = [int.from_bytes(r["c"][:4], "little") for r in own]
        other = np.concatenate([unpacked(r["c"]) for r in own])
        order = np.lexsort((other, key))
        fresh = _heads(key[order], other[order])
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(fresh) - 1
        trained = np.bincount(place, np.concatenate([_numbers(r["d"]) for r in own])).astype(np.int64)
        for r, at in zip(own, np.split(place, np.cumsum(sizes)[:-1])):
            found.append((part, kind + _WORD_ASKED, r["block"], steps(at), r["e"], r["f"]))
        one = order[fresh]
        key = key[one]
        opens = np.flatnonzero(_heads(key))
        return key[opens], np.diff(np.append(opens, len(key))), other[one], trained

    return _gathered(blocks, parts).mapInArrow(build, _ROWS)


# --- a part in a round ------------------------------------------------------------------


@dataclass
class State:
    """What everyone knows before a round: totals, and the class restaurants of frequent words."""

    totals: Totals
    node_count: np.ndarray
    node_tables: np.ndarray
    root_count: np.ndarray
    root_tables: np.ndarray

    @classmethod
    def empty(cls, rule: LmRule, words: int) -> State:
        nodes = [np.zeros((words, rule.classes), np.int32) for _ in range(2)]
        return cls(Totals.empty(rule), *nodes, np.zeros(words), np.zeros(words))


class Guests:
    """Frequent words in the contexts of other words: leaves below class restaurants that are elsewhere."""

    def __init__(self, word: np.ndarray, kind: np.ndarray, context: np.ndarray, count: np.ndarray, rule: LmRule):
        self.rule, self.word, self.kind, self.context, self.count = rule, word, kind, context, count
        self.tables, self.several = np.minimum(count, 1), np.flatnonzero(count > 1)

    def sweep(self, state: State, rare_tables: np.ndarray, base: float, draw) -> None:
        rule, totals, own = self.rule, state.totals, self.several
        (d0, d1, d2), (s0, s1, s2) = rule.discount, rule.strength
        word, node = self.word[own], rule.contexts + self.kind[own]
        pull0, size0 = s0 + d0 * totals.tables[-1], s0 + totals.customers[-1]
        served = Seating._served
        root = served(state.root_count[word], state.root_tables[word], d0, pull0 * base, size0)
        left = np.maximum(state.node_count[word, self.kind[own]] - self.tables[own], 0)
        tables = np.minimum(state.node_tables[word, self.kind[own]], left)
        parent = served(left, tables, d1, (s1 + d1 * totals.tables[node]) * root, s1 + totals.customers[node])
        pull = s2 + d2 * rare_tables[self.context[own]]
        self.tables[own] = seat(self.count[own], pull * parent, d2, draw)


class Part:
    """The restaurants of a part: its words' in all contexts, and its rare contexts' of frequent words."""

    def __init__(self, held: list[dict], ids: Ids, parent: np.ndarray, rule: LmRule, parts: int):
        self.rule = rule
        rows = {r["kind"]: r for r in held if r["kind"] in (_WORD, _CONTEXT, _NAMES)}
        self.names = summed(rows[_NAMES]["a"]).view(np.uint64)
        self.owner = _owner(self.names, parts)
        self.parent = np.concatenate([parent, ids.kinds(self.names)])
        many, context, self.trained = (_numbers(rows[_WORD][c]) for c in "bcd")
        rare = context > ids.last
        self.context = np.where(rare, rule.contexts - ids.last - 1, rule.classes) + context
        self.number = np.repeat(np.arange(len(many)), many)
        self.count = np.bincount(self.number, self.trained, minlength=len(many))
        # only words of the training part have a seat
        self.seat = np.where(self.count > 0, np.cumsum(self.count > 0) - 1, -1)[self.number]
        own = self.trained > 0
        self.seating = Seating(self.seat[own], self.context[own], self.trained[own], self.parent, rule)
        many, self.guest_word, guest_count = (_numbers(rows[_CONTEXT][c]) for c in "bcd")
        self.guest_context = np.repeat(summed(rows[_CONTEXT]["a"]), many)
        self.guest_kind = self.parent[rule.contexts + self.guest_context]
        self.known_guest = guest_count > 0
        columns = (self.guest_word, self.guest_kind, self.guest_context, guest_count)
        self.guests = Guests(*(c[self.known_guest] for c in columns), rule)

    def answers(self, held: list[dict], kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of the part's rare contexts, from those that they are dealt to."""
        rows = sorted((r for r in held if r["kind"] == kind), key=lambda r: r["block"])
        found = [np.concatenate([np.zeros(0, np.int64), *(_numbers(r[c]) for r in rows)]) for c in ("a", "b")]
        assert len(found[0]) == len(self.names)
        return tuple(f.astype(float) for f in found)

    def sweeps(self, number: int, state: State, tables: np.ndarray, base: float, draw) -> None:
        """``number`` sweeps of guests; the rest is swept likewise by its own class."""
        for _ in range(number):
            self.guests.sweep(state, tables, base, draw)

    def averaged(self, state: State, tables: np.ndarray, base: float, part: int) -> np.ndarray:
        """Sums of the guests' tables over the sweeps that predictions are made from."""
        draw = np.random.Generator(np.random.PCG64([self.rule.seed, part, 2]))
        total = np.zeros(len(self.guests.count), np.int64)
        self.sweeps(self.rule.burn_in, state, tables, base, draw)
        for _ in range(self.rule.samples):
            self.sweeps(1, state, tables, base, draw)
            total += self.guests.tables
        return total

    def rows(self, part: int, totals: Totals, guest_tables: np.ndarray, factor: int, parts: int) -> Iterator[tuple]:
        """What a round sends on; tables of rare contexts as whole numbers, ``factor`` times."""
        many, rule, g = len(self.names), self.rule, self.guests
        tables = np.rint(totals.rare_tables * factor).astype(np.int64)
        tables += np.bincount(g.context, guest_tables, minlength=many).astype(np.int64)
        customers = np.rint(totals.rare_customers).astype(np.int64) + np.bincount(g.context, g.count, minlength=many).astype(np.int64)
        here = np.unique(self.owner)
        cuts = np.append(np.searchsorted(self.owner, here), many).tolist()
        for q, a, b in zip(here.tolist(), cuts, cuts[1:]):
            yield q, _UP, part, steps(self.names[a:b]), packed(customers[a:b]), packed(tables[a:b])
        yield _totals_row(parts + FREQUENT_PARTS, totals)
        cell = np.bincount(g.word * rule.classes + g.kind, guest_tables)
        used = np.flatnonzero(cell)
        group = used // rule.classes % FREQUENT_PARTS
        for p in np.unique(group).tolist():
            own = used[group == p]
            yield parts + p, _GUESTS, part, steps(own), packed(cell[own])


def _totals_row(part: int, totals: Totals) -> tuple:
    return part, _TOTALS, 0, totals.customers.tobytes(), totals.tables.tobytes()


def _draw(rule: LmRule, part: int) -> np.random.Generator:
    """The same draws whenever the last round of a part is gone through."""
    return np.random.Generator(np.random.PCG64([rule.seed, part, 1]))


def _frequent_seating(held: list[dict], parent, factor: int, rule: LmRule):
    """Restaurants of some frequent words, with their customers from rare contexts; numbers of the words."""
    own = [r for r in held if r["kind"] == _FREQUENT]
    guests = [r for r in held if r["kind"] == _GUESTS]
    cell, at = np.unique(np.concatenate([np.zeros(0, np.int64), *(summed(r["a"]) for r in guests)]), return_inverse=True)
    tables = np.bincount(at, np.concatenate([np.zeros(0), *(_numbers(r["b"]) for r in guests)]), minlength=len(cell))
    word = np.concatenate([cell // rule.classes, *(summed(r["a"]) for r in own)])
    context = np.concatenate([cell % rule.classes, *(rule.classes + _numbers(r["b"]) for r in own)])
    # a cell with a guest has one at least
    count = np.concatenate([np.maximum(np.rint(tables / factor), 1).astype(np.int64), *(_numbers(r["c"]) for r in own)])
    names, number = np.unique(word, return_inverse=True)
    key, at = np.unique(number * rule.contexts + context, return_inverse=True)
    total = np.bincount(at, count, minlength=len(key)).astype(np.int64)
    return Seating(key // rule.contexts, key % rule.contexts, total, parent, rule), names


@dataclass
class Round:
    """Rows that answer the parts, sums of guests by frequent word, and what everyone knows next."""

    down: DataFrame
    guests: DataFrame
    state: State


def _round(
    merged: DataFrame, sent, parent, before: Round | None, words: int, base: float, rule: LmRule, parts: int, average: bool = False
) -> Round:
    """Another round of sweeps (none: the first seating), or the averages over
    the sweeps that predictions will be made from."""
    spark = merged.sparkSession
    known = spark.sparkContext.broadcast(before.state if before else None)
    factor = rule.samples if average else 1
    pairs = merged.where(F.col("kind").isin(_WORD, _CONTEXT, _NAMES))
    if before:
        pairs = pairs.union(before.down)

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = known.value
        for part, held in _by_part(batches):
            own = Part(held, sent.value, parent, rule, parts)
            guests = own.guests
            if state is None:
                totals, guest_tables = own.seating.totals(), guests.tables
            else:
                totals = _with_answers(state.totals, *own.answers(held, _DOWN))
                if average:
                    guest_tables = own.averaged(state, totals.rare_tables, base, part)
                    totals = Predictor(own.seating, totals, base, _draw(rule, part)).average
                else:
                    draw = np.random.Generator(np.random.PCG64([rule.seed, part]))
                    for _ in range(rule.burn_in):
                        own.seating.sweep(totals, base, draw)
                    own.sweeps(rule.burn_in, state, totals.rare_tables, base, draw)
                    totals, guest_tables = own.seating.totals(), guests.tables
            yield _table(list(own.rows(part, totals, guest_tables, factor, parts)))

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = known.value
        for part, held in _by_part(batches):
            if part < parts:
                yield _table(list(_sums(part, held, _LAST if average else _DOWN)))
            elif part == parts + FREQUENT_PARTS:
                yield _table([_totals_row(part, _added(held, rule))])
            else:
                made, names = _frequent_seating(held, parent, factor, rule)
                if average:
                    totals = Predictor(made, state.totals, base, _draw(rule, part)).average
                else:
                    draw = np.random.Generator(np.random.PCG64([rule.seed, part]))
                    for _ in range(rule.burn_in if state else 0):
                        made.sweep(state.totals, base, draw)
                    totals = made.totals()
                cell = names[made.node_word] * rule.classes + made.node_class
                found = [r for r in held if r["kind"] == _GUESTS]
                yield _table([
                    _totals_row(part, totals),
                    (part, _STATE, 0, steps(cell), packed(made.node_count), packed(made.node_tables), steps(names),
                     packed(made.root_count), packed(made.root_tables)),
                    *(tuple(r.values()) for r in found if average),
                ])

    sums = _gathered(pairs, parts).mapInArrow(swept, _ROWS)
    sums = sums.union(merged.where(f"kind = {_FREQUENT}"))
    out = settled(_gathered(sums, parts + FREQUENT_PARTS + 1).mapInArrow(answered, _ROWS))
    state = State.empty(rule, words)
    # a few rows, of the restaurants that are bounded in number
    for r in out.where(F.col("kind").isin(_TOTALS, _STATE)).collect():
        if r.kind == _TOTALS:
            state.totals.customers += np.frombuffer(r.a)
            state.totals.tables += np.frombuffer(r.b)
        else:
            cell, names = summed(r.a), summed(r.d)
            state.node_count.reshape(-1)[cell], state.node_tables.reshape(-1)[cell] = _numbers(r.b), _numbers(r.c)
            state.root_count[names], state.root_tables[names] = _numbers(r.e), _numbers(r.f)
    return Round(out.where(F.col("kind").isin(_DOWN, _LAST)), out.where(f"kind = {_GUESTS}"), state)


def _with_answers(totals: Totals, customers: np.ndarray, tables: np.ndarray) -> Totals:
    return Totals(totals.customers, totals.tables, customers, tables)


def _sums(part: int, held: list[dict], kind: int) -> Iterator[tuple]:
    """Customers and tables of each rare context over all parts, to those that named it."""
    names, at = np.unique(np.concatenate([summed(r["a"]) for r in held]), return_inverse=True)
    totals = [np.bincount(at, np.concatenate([_numbers(r[c]) for r in held])).astype(np.int64)[at] for c in ("b", "c")]
    cuts = np.cumsum([int.from_bytes(r["b"][:4], "little") for r in held])[:-1]
    for r, customers, tables in zip(held, *(np.split(t, cuts) for t in totals)):
        yield r["block"], kind, part, packed(customers), packed(tables)


def _added(held: list[dict], rule: LmRule) -> Totals:
    out = Totals.empty(rule)
    for r in held:
        out.customers += np.frombuffer(r["a"])
        out.tables += np.frombuffer(r["b"])
    return out


def lm_scores(docs: DataFrame, rule: LmRule = LmRule()) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    NULL and empty texts are one end token.  Rows with the same id and text
    get equal scores.  Without any training token all words are unseen.  An
    empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("doc_id").isNull().cast("bigint").alias("nothing"),
        F.crc32(F.concat(F.coalesce(F.col("text"), F.lit("")), F.lit("|")).cast("binary")).alias("crc"),
        held_out(F.col("doc_id")).alias("held"),
        F.col("text").cast("string").alias("text"),
    )
    counts = stable(_word_counts(rows, rule).groupBy("word").agg(F.sum("n").alias("n"), F.min("kind").alias("kind")))
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.where(F.col("word") != int(_END.view(np.int64))).orderBy(F.desc("n"), "word").limit(rule.frequent).collect()
    ends = counts.where(F.col("word") == int(_END.view(np.int64))).first()
    known = Frequent([r.word for r in top])
    number = {int(h): int(i) for h, i in zip(known.hash.view(np.int64), known.number)}
    trained = np.zeros(len(known.hash) + 1, np.int64)
    for r in [*top, *([ends] if ends else [])]:
        trained[number[r.word]] = r.n
    parent = _parents(known, {r.word: r.kind for r in top}, rule)
    sent = spark.sparkContext.broadcast(Ids(known, _numbered(counts, known), rule))

    slots = max(int(n * 1.3) // rule.tokens_per_part + 1, min(24, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    merged = settled(_merged(_blocks(rows, sent, rule, slots), sent, slots))
    base = (1 - rule.unseen) / max(v, 1)
    words = len(known.hash) + 1
    last = _round(merged, sent, parent, None, words, base, rule, slots)
    for _ in range(rule.rounds):
        last = _round(merged, sent, parent, last, words, base, rule, slots)
    average = _round(merged, sent, parent, last, words, base, rule, slots, average=True)

    table = _frequent_table(merged, average.guests, parent, last.state.totals, average.state.totals, base, rule, words)
    model = spark.sparkContext.broadcast((table, trained, n, v))
    here = _score_frequent(rows, sent, model, rule)
    there = _score_rest(merged, sent, model, parent, last, average, base, rule, slots)
    keys = ["doc_id", "nothing", "crc"]
    sums = here.unionByName(there).groupBy(*keys).agg(
        F.sum("copies").alias("copies"),
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")],
    )
    sums = sums.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    ident = F.when(F.col("nothing") == 0, F.col("doc_id"))
    return sums.select(
        ident.alias("doc_id"),
        held_out(ident).alias("held_out"),
        (F.col("n_tokens") / F.col("copies")).cast("bigint").alias("n_tokens"),
        (F.col("n_known") / F.col("copies")).cast("bigint").alias("n_known"),
        F.lit(int(n)).cast("bigint").alias("train_tokens"),
        (F.col("base_score") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"),
    )


def _word_counts(rows: DataFrame, rule: LmRule) -> DataFrame:
    """Training counts and classes of words, summed up over a bounded number of them at a time."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def summed():
            names, one, at = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
            sums = np.bincount(at, np.concatenate([h[1] for h in held]), minlength=len(names)).astype(np.int64)
            return names, sums, np.concatenate([h[2] for h in held])[one]

        def out(names, sums, kinds):
            return pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(sums), pa.array(kinds)], names=["word", "n", "kind"]
            )

        for batch in batches:
            batch = batch.filter(pc.invert(batch.column("held")))
            for piece in pieces(batch):
                t = tokens(piece.column("text"), rule.classes)
                names, one, sums = np.unique(t.hash, return_index=True, return_counts=True)
                held.append((names, sums, t.kind[one]))
                if sum(len(h[0]) for h in held) > 2_000_000:
                    held = [summed()]
                    if len(held[0][0]) > 1_000_000:
                        yield out(*held.pop())
        if held:
            yield out(*summed())

    return rows.select("held", "text").mapInArrow(build, "word bigint, n bigint, kind bigint")


def _numbered(counts: DataFrame, known: Frequent) -> list[tuple[int, int]]:
    """Hashes and classes of the commonest other words: all above a power of two that few enough reach."""
    power = F.floor(F.log2("n")).cast("int")
    many = {r.power: r["count"] for r in counts.groupBy(power.alias("power")).count().collect()}
    least = 63
    while least and sum(m for p, m in many.items() if p >= least - 1) <= _NUMBERED - len(known.hash):
        least -= 1
    chosen = counts.where(power >= least).select("word", "kind").orderBy("word").collect()
    frequent = set(known.hash.view(np.int64).tolist())
    return [(r.word, r.kind) for r in chosen if r.word not in frequent]


def _parents(known: Frequent, kinds: dict[int, int], rule: LmRule) -> np.ndarray:
    """Class of every context; a frequent word's is that of its last bytes in ``kinds``."""
    out = np.zeros(rule.contexts, np.int64)
    out[: rule.classes] = np.arange(rule.classes)
    # the end has no bytes and is of class 0
    out[rule.classes + known.number] = [kinds.get(h, 0) for h in known.hash.view(np.int64).tolist()]
    return out


def _frequent_table(merged, guests, parent, totals, average, base, rule: LmRule, size: int) -> np.ndarray:
    """log10 P(word | context) of the frequent words, words x contexts at most."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held in _by_part(batches):
            made, names = _frequent_seating(held, parent, rule.samples, rule)
            predictor = Predictor(made, totals, base, _draw(rule, part), average)
            every = np.arange(rule.contexts)
            for i, name in enumerate(names.tolist()):
                p = predictor.probability(np.full(rule.contexts, i), every, parent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name], pa.int64()), pa.array([np.log10(p).tobytes()])], names=["word", "row"]
                )

    start = (1 - rule.unseen) / 2
    table = np.full((size, rule.contexts), np.log10(start))
    held = _gathered(merged.where(f"kind = {_FREQUENT}").union(guests), FREQUENT_PARTS)
    for r in held.mapInArrow(build, "word bigint, row binary").collect():
        table[r.word] = np.frombuffer(r.row)
    return table


_SUMS = "doc_id bigint, nothing bigint, crc bigint, copies bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def _score_frequent(rows: DataFrame, sent, model, rule: LmRule) -> DataFrame:
    """Sums of frequent words, by document; their scores in frequent contexts only."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, trained, n, v = model.value
        known = sent.value.known
        base = np.log10((trained + 0.5) / (n + 0.5 * (v + 1)))
        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                t = tokens(piece.column("text"), rule.classes)
                code = known.of(t.hash)
                context = np.empty_like(code)
                context[1:] = code[:-1]
                # texts begin after an end
                context[t.first[:-1]] = 1
                own = code > 0
                both = own & (context > 0)
                doc, many = t.doc[own], piece.num_rows
                sums = [
                    np.bincount(doc, trained[code[own]] > 0, minlength=many).astype(np.int64),
                    np.bincount(doc, base[code[own]], minlength=many),
                    np.bincount(t.doc[both], table[code[both], rule.classes + context[both]], minlength=many).astype(float),
                ]
                ids = [piece.column("doc_id").fill_null(0), piece.column("nothing"), piece.column("crc")]
                made = [np.ones(many, np.int64), np.diff(t.first).astype(np.int64), *sums]
                yield pa.RecordBatch.from_arrays(
                    [*ids, *map(pa.array, made)], names=[f.split()[0] for f in _SUMS.split(", ")]
                )

    return rows.mapInArrow(build, _SUMS)


def _score_rest(merged, sent, model, parent, last: Round, average: Round, base: float, rule: LmRule, parts: int) -> DataFrame:
    """Sums of all other words, and of frequent words in rare contexts, by document."""
    known = merged.sparkSession.sparkContext.broadcast((last.state, average.state.totals))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (state, totals), (table, _, n, v) = known.value, model.value
        d2, s2 = rule.discount[2], rule.strength[2]
        for part, held in _by_part(batches):
            own = Part(held, sent.value, parent, rule, parts)
            before = _with_answers(state.totals, *own.answers(held, _DOWN))
            customers, tables = own.answers(held, _LAST)
            after = _with_answers(totals, customers, tables / rule.samples)
            predictor = Predictor(own.seating, before, base, _draw(rule, part), after)
            word_score = np.log10(predictor.probability(own.seat, own.context, own.parent))
            count = own.count[own.number]
            flat = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))

            guest_tables = own.averaged(state, before.rare_tables, base, part)
            held_by = np.zeros(len(own.guest_word))
            held_by[own.known_guest] = own.guests.count - d2 * guest_tables / rule.samples
            at = own.guest_context
            p = (held_by + (s2 + d2 * after.rare_tables[at]) * 10 ** table[own.guest_word, own.guest_kind]) / (s2 + customers[at])
            guest_score = np.log10(p)

            found: dict[int, list] = {}
            for r in held:
                if r["kind"] not in (_WORD_ASKED, _CONTEXT_ASKED):
                    continue
                entry, doc = np.repeat(summed(r["a"]), _numbers(r["b"])), _numbers(r["c"])
                values = (count[entry] > 0, flat[entry], word_score[entry]) if r["kind"] == _WORD_ASKED else (None, None, guest_score[entry])
                found.setdefault(r["block"], []).append((doc, values))
            out = []
            for block, asked in found.items():
                many = max(int(doc.max(initial=-1)) for doc, _ in asked) + 1
                sums, there = np.zeros((3, many)), np.zeros(many, bool)
                for doc, values in asked:
                    there[doc] = True
                    for total, x in zip(sums, values):
                        if x is not None:
                            total += np.bincount(doc, x, minlength=many)
                where = np.flatnonzero(there)
                out.append((block, steps(where), packed(sums[0, where]), sums[1, where].tobytes(), sums[2, where].tobytes()))
            if out:
                yield _summary(out)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            none = pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("block"), none, *(batch.column(c) for c in "abc")], names=_SUMMARY_NAMES)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _by_part(batches, "block"):
            names = next((r for r in held if not r["doc"]), None)
            if names is None:
                continue
            keys = [np.frombuffer(names[c], np.int64) for c in ("known", "base", "score")]
            total = np.zeros((3, len(keys[0])))
            for r in held:
                if r["doc"]:
                    where = summed(r["doc"])
                    for i, x in enumerate((_numbers(r["known"]), np.frombuffer(r["base"]), np.frombuffer(r["score"]))):
                        total[i, where] += x
            none = np.zeros(len(keys[0]), np.int64)
            made = [*keys, none, none, total[0].astype(np.int64), total[1], total[2]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in made], names=[f.split()[0] for f in _SUMS.split(", ")]
            )

    asked = merged.where(F.col("kind").isin(_WORD, _CONTEXT, _NAMES, _WORD_ASKED, _CONTEXT_ASKED))
    asked = asked.union(last.down).union(average.down)
    sums = _gathered(asked, parts).mapInArrow(build, _SUMMARY)
    named = merged.where(f"kind = {_IDS}").mapInArrow(ids, _SUMMARY)
    # a block's rows hold at most a row per token of one piece
    return sums.union(named).repartition("block").sortWithinPartitions("block").mapInArrow(unpack, _SUMS)


_SUMMARY = "block bigint, doc binary, known binary, base binary, score binary"
_SUMMARY_NAMES = [f.split()[0] for f in _SUMMARY.split(", ")]


def _summary(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_SUMMARY_NAMES)


def perplexity(scores: DataFrame) -> DataFrame:
    """10 ** (-log10 probability per token), of held-out and training documents."""
    def per_token(column):
        return F.pow(F.lit(10.0), -F.sum(column) / F.sum("n_tokens"))

    return scores.groupBy("held_out").agg(
        F.sum("n_tokens").alias("tokens"), per_token("score").alias("perplexity"), per_token("base_score").alias("base_perplexity")
    )
