"""Repeated passages by chaining of shared k-mer seeds.

Every word k-mer is a seed.  A passage of ``least`` words with a share of
1 - ``similarity`` of them edited keeps ``least - size + 1 - size * edits`` of
its k-mers, seven of 50 words by ``EVERY_SEED``, so a pair of documents with fewer has
no such passage.  Occurrences of a seed with few of them are all anchored to
each other.  Those of a common seed are anchored to the first one and to the
last one of the document before; where some of the seeds in a row are common, longer units
of the row are seeds as well, so that a partner holding the same row is found
while its copies stay one class.  A chain with a seed of few occurrences that lacks some
seeds is compared word by word as well where common seeds around could make them up.
Anchors of two documents are chained in
order by dynamic programming with gap costs over a Fenwick tree, chains are
extended and aligned word by word, and stretches of enough words and likeness
are repeated passages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight.llm.edit_embedding import edit_distance
from subsight.llm.storage import release, settled
from subsight.llm.text import mix, pieces, words

_U = np.uint64
_FACTOR = np.random.Generator(np.random.PCG64(41)).integers(1, 2**63, 64, dtype=np.uint64) | _U(1)


@dataclass(frozen=True)
class PassageRule:
    """Passages have ``least`` words; ``gap_cost`` is per word skipped on either side."""

    size: int = 6
    #: of so many k-mers in a row the smallest one is a seed
    window: int = 1
    #: times that rows of shared seeds are put together to units of double length
    doublings: int = 3
    #: occurrences up to which a seed anchors each to each
    few: int = 8
    least: int = 50
    similarity: float = 0.8
    gap_cost: float = 0.05
    max_gap: int = 64
    margin: int = 40
    #: words of a document that travel together
    block: int = 64
    #: bytes of text whose seeds one task holds
    part_bytes: int = 8 << 20
    #: shares of the chains whose words are gathered one after the other
    shares: int = 4

    @property
    def shared(self) -> int:
        """K-mers that a passage of the least length and similarity surely shares."""
        edits = int(self.least * (1 - self.similarity) + 1e-9)
        return max(1, self.least - self.size + 1 - self.size * edits)

    @property
    def wide(self) -> int:
        """Words by which a passage of the least length reaches beyond a seed of it, at most."""
        return self.least + int(self.least * (1 - self.similarity) + 1e-9)


#: Four words are the most that a passage of similarity 0.8 is sure to share in a row;
#: gaps up to ``max_gap`` cost less than a seed gains.
EVERY_SEED = PassageRule(size=4, gap_cost=0.02)


def minimisers(hashes: np.ndarray, first: np.ndarray, size: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, position, seed) of the smallest k-mer of every window of k-mers."""
    count = len(hashes) - size + 1
    none = np.zeros(0, np.int64)
    if count <= 0:
        return none, none, np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        value = np.zeros(count, np.uint64)
        for j in range(size):
            value += hashes[j : j + count] * _FACTOR[j]
        value = mix(value)
    many = np.maximum(np.diff(first) - size + 1, 0)
    if window == 1:
        doc = np.repeat(np.arange(len(many)), many)
        pos = _ranges(many)
        return doc, pos, value[first[doc] + pos]
    chosen = [none]
    if count >= window:
        windows = np.lib.stride_tricks.sliding_window_view(value, window)
        begin = np.repeat(first[:-1], np.maximum(many - window + 1, 0)) + _ranges(np.maximum(many - window + 1, 0))
        for lo in range(0, len(begin), 1 << 18):
            own = begin[lo : lo + (1 << 18)]
            chosen.append(own + windows[own].argmin(axis=1))
    for d in np.flatnonzero((many > 0) & (many < window)):
        chosen.append(np.array([first[d] + int(value[first[d] : first[d] + many[d]].argmin())]))
    at = np.unique(np.concatenate(chosen))
    doc = np.searchsorted(first, at, side="right") - 1
    return doc, at - first[doc], value[at]


def _ranges(counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def chains(pos: np.ndarray, target: np.ndarray, rule: PassageRule) -> list[tuple[int, int, int, int, int]]:
    """(first, last + 1, target first, target last + 1, anchors) of the best chains.

    A chain increases strictly on both sides.  An anchor's score is the seed's
    length plus the best score before it less the cost of the gap; as that cost
    is linear, a prefix maximum over target positions finds the best one.
    Each anchor is in one chain at most, better chains first.
    """
    order = np.lexsort((-target, pos))
    target = target[order]
    places = (np.unique(target, return_inverse=True)[1] + 1).tolist()
    pos, target = pos[order].tolist(), target.tolist()
    size, cost, k = max(places, default=0), rule.gap_cost, rule.size
    # best score + cost * coordinates, and its anchor, over a prefix of target positions
    tree, anchor = [-np.inf] * (size + 1), [-1] * (size + 1)
    score, back = [0.0] * len(pos), [-1] * len(pos)
    for i, place in enumerate(places):
        away = cost * (pos[i] + target[i])
        at, best, whose = place - 1, -np.inf, -1
        while at:
            # of equal ones the later anchor
            if tree[at] > best or tree[at] == best and anchor[at] > whose:
                best, whose = tree[at], anchor[at]
            at &= at - 1
        own = k
        if whose >= 0 and best - away > 0:
            back[i] = whose
            own += best - away
        score[i] = own
        entry, at = own + away, place
        while at <= size:
            if entry >= tree[at]:
                tree[at], anchor[at] = entry, i
            at += at & -at
    used, found, gap = [False] * len(pos), [], rule.max_gap
    for i in np.argsort(-np.array(score), kind="stable").tolist():
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        if not chain:
            continue
        chain.reverse()
        cut, last = 0, chain[0]
        for j, here in enumerate(chain):
            if pos[here] - pos[last] > gap or target[here] - target[last] > gap:
                a = chain[cut]
                found.append((pos[a], pos[last] + k, target[a], target[last] + k, j - cut))
                cut = j
            last = here
        a = chain[cut]
        found.append((pos[a], pos[last] + k, target[a], target[last] + k, len(chain) - cut))
    return found


# --- packed columns: sorted or small integers, a few bytes each --------------------


def _packed(values: np.ndarray) -> bytes:
    """Byte planes of unsigned integers, compressed."""
    values = np.ascontiguousarray(values).astype(np.uint64)
    width = (int(values.max(initial=0)).bit_length() + 7) // 8
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(values).to_bytes(4, "little") + bytes([width]) + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def _unpacked(data: bytes) -> np.ndarray:
    many, width = int.from_bytes(data[:4], "little"), data[4]
    out = np.zeros((many, 8), np.uint8)
    if many and width:
        planes = pa.decompress(data[5:], many * width, "zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, many).T
    return out.reshape(-1).view(np.uint64)


def _steps(values: np.ndarray) -> bytes:
    """Integers by their differences, which are small where values are sorted."""
    steps = np.diff(values.astype(np.int64), prepend=0)
    return _packed(((steps << 1) ^ (steps >> 63)).view(np.uint64))


def _summed(data: bytes) -> np.ndarray:
    steps = _unpacked(data)
    return np.cumsum((steps >> _U(1)).view(np.int64) ^ -(steps & _U(1)).view(np.int64))


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(f.split() for f in schema.split(", ")))
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(columns, types)], names=list(names))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one part together; they follow each other."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["part"] != row["part"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _gathered(df: DataFrame, slots: int) -> DataFrame:
    return df.repartition(slots, "part").sortWithinPartitions("part")


# --- occurrences, dealt out by seed -------------------------------------------------

_DEALT = "part int, length int, docs binary, doc binary, pos binary, seed binary"
#: Seeds that are held before they are dealt out, and occurrences among them that make
#: a seed so hot that its occurrences are spread over so many parts.
_HELD, _HOT, _SPREAD = 1_000_000, 4096, 64


def _deal(doc: np.ndarray, pos: np.ndarray, seed: np.ndarray, length: int, slots: int, rule: PassageRule) -> list[tuple]:
    """Packed occurrences; a part has a range of the seeds, whose upper 48 bits count."""
    if not len(seed):
        return []
    order = np.argsort(seed, kind="stable")
    doc, pos, key = doc[order], pos[order], seed[order] >> _U(16)
    part = ((key >> _U(16)) * _U(slots) >> _U(32)).astype(np.int64)
    opens = np.append(True, key[1:] != key[:-1])
    head = np.flatnonzero(opens)
    many = np.diff(np.append(head, len(key)))
    hot = np.repeat(many > _HOT, many)
    found = []

    def emit(part, doc, pos, key):
        cuts = np.flatnonzero(np.diff(part)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)]):
            if lo < hi:
                names, own = np.unique(doc[lo:hi], return_inverse=True)
                found.append((int(part[lo]), length, _steps(names), _packed(own), _packed(pos[lo:hi]), _steps(key[lo:hi].view(np.int64))))

    if hot.any():
        spread = (part[hot] + 1 + (mix(doc[hot].view(np.uint64)) % _U(_SPREAD)).astype(np.int64)) % slots
        again = np.lexsort((key[hot], spread))
        emit(spread[again], doc[hot][again], pos[hot][again], key[hot][again])
        # enough of them stay with the seed's other occurrences to be common there and to link both
        kept = ~hot | (np.arange(len(key)) - np.repeat(head, many) <= rule.few)
        part, doc, pos, key = part[kept], doc[kept], pos[kept], key[kept]
    emit(part, doc, pos, key)
    return found


def _seeds(rows: DataFrame, rule: PassageRule, slots: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def dealt():
            doc, pos, seed = (np.concatenate(c) for c in zip(*held))
            held.clear()
            return _table(_deal(doc, pos, seed, rule.size, slots, rule), _DEALT)

        for batch in batches:
            for piece in pieces(batch):
                w = words(piece.column("text"))
                doc, pos, seed = minimisers(w.hash, w.first, rule.size, rule.window)
                held.append((np.asarray(piece.column("doc"))[doc], pos, seed))
                if sum(len(h[2]) for h in held) >= _HELD:
                    yield dealt()
        if held:
            yield dealt()

    return rows.mapInArrow(build, _DEALT)


def _units(links: DataFrame, rule: PassageRule, slots: int) -> DataFrame:
    """Longer units in rows of shared seeds, some of them common, dealt out likewise.

    A unit joins halves of equal length; of units of n words one in n / (2 * size)
    is kept, by its hash, so all occurrences or none.
    """
    reach = rule.size << rule.doublings

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _parts(batches):
            columns = []
            for r in held:
                columns.append((_summed(r["docs"])[_summed(r["doc"])], _summed(r["pos"]), _unpacked(r["other"]), _unpacked(r["shift"])))
            doc, pos, value, common = (np.concatenate(c) for c in zip(*columns))
            order = np.lexsort((value, pos, doc))
            doc, pos, here, common = doc[order], pos[order], value[order], common[order] > 0
            fresh = np.append(True, (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1]))
            doc, pos, here, common = doc[fresh], pos[fresh], here[fresh], common[fresh]
            at, length, found = np.arange(len(doc)), rule.size, []
            while length < reach and len(at):
                ahead = np.minimum(at + length, len(doc) - 1)
                joined, known = np.zeros(len(doc), np.uint64), np.zeros(len(doc), bool)
                known[at] = True
                # places of a document are distinct and in order, so only rows without holes have this one
                whole = (doc[ahead] == doc[at]) & (pos[ahead] == pos[at] + length) & known[ahead]
                at, ahead = at[whole], ahead[whole]
                with np.errstate(over="ignore"):
                    joined[at] = mix(here[at] * _FACTOR[0] + here[ahead] * _FACTOR[1] + _U(length))
                here, length = joined, 2 * length
                common = common | (known & common[np.minimum(np.arange(len(doc)) + length // 2, len(doc) - 1)])
                kept = at[(here[at] >> _U(20)) % _U(length // (2 * rule.size)) == 0]
                kept = kept[common[kept]]
                found += _deal(doc[kept], pos[kept], here[kept], length, slots, rule)
            yield _table(found, _DEALT)

    return _gathered(links.where(f"kind = {_PLACE}"), slots).mapInArrow(build, _DEALT)


# --- anchors, dealt out by document -------------------------------------------------

_LINKS = "part int, kind int, docs binary, doc binary, pos binary, other binary, shift binary, length binary"
#: Kinds of rows: anchors of seeds with few occurrences, of common ones, and occurrences.
_FEW, _COMMON, _PLACE = 0, 1, 2


def _links(dealt: DataFrame, rule: PassageRule, slots: int, places: bool) -> DataFrame:
    """Anchors, from the later to the earlier occurrence; ``places``: the shared occurrences as well."""

    def packed(kind, doc, pos, other, second, length):
        """``other`` and ``second``: source and its place, or seed and whether it is common."""
        part = (mix(doc.view(np.uint64)) % _U(slots)).astype(np.int64)
        order = np.lexsort((pos, doc, part) if kind == _PLACE else (pos, other, doc, part))
        part, doc, pos, other, second, length = (c[order] for c in (part, doc, pos, other, second, length))
        cuts = np.searchsorted(part, np.arange(slots + 1))
        for p in np.unique(part).tolist():
            own = slice(cuts[p], cuts[p + 1])
            if kind == _PLACE:
                names, at = np.unique(doc[own], return_inverse=True)
                last = _packed(other[own]), _packed(second[own]), b""
            else:
                names, at = np.unique(np.concatenate([doc[own], other[own]]), return_inverse=True)
                at, source = np.split(at, 2)
                last = _steps(source), _steps(second[own] - pos[own]), _packed(length[own])
            yield p, kind, _steps(names), _steps(at), _steps(pos[own]), *last

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _parts(batches):
            key = np.concatenate([_summed(r["seed"]) for r in held])
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            order = order[np.append(same, False) | np.append(False, same)]
            if not len(order):
                continue
            doc = np.concatenate([_summed(r["docs"])[_unpacked(r["doc"]).view(np.int64)] for r in held])[order]
            pos = np.concatenate([_unpacked(r["pos"]).view(np.int64) for r in held])[order]
            length = np.repeat([r["length"] for r in held], [int.from_bytes(r["pos"][:4], "little") for r in held])[order]
            key = key[order]
            order = np.lexsort((pos, doc, key))
            key, doc, pos, length = key[order], doc[order], pos[order], length[order]
            # repeated rows of one document are one
            fresh = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1]))
            key, doc, pos, length = key[fresh], doc[fresh], pos[fresh], length[fresh]
            head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            many = np.diff(np.append(head, len(key)))
            start, many = np.repeat(head, many), np.repeat(many, many)
            at = np.arange(len(key))
            common = many > rule.few
            later, earlier = [at[:0]], [at[:0]]
            for step in range(1, rule.few):
                own = at[~common & (at - start >= step)]
                later.append(own)
                earlier.append(own - step)
            own = at[common & (at > start)]
            # the last occurrence in the document before
            group = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
            before = np.repeat(group, np.diff(np.append(group, len(key)))) - 1
            second = own[before[own] > start[own]]
            ends = [
                (_FEW, np.concatenate(later), np.concatenate(earlier)),
                (_COMMON, np.concatenate([own, second]), np.concatenate([start[own], before[second]])),
            ]
            for kind, i, j in ends:
                for lo in range(0, len(i), _HELD):
                    x, y = i[lo : lo + _HELD], j[lo : lo + _HELD]
                    yield _table(list(packed(kind, doc[x], pos[x], doc[y], pos[y], length[x])), _LINKS)
            if places:
                own = many > 1
                rows = packed(_PLACE, doc[own], pos[own], key[own].view(np.uint64), common[own], length[own])
                yield _table(list(rows), _LINKS)

    return _gathered(dealt, slots).mapInArrow(build, _LINKS)


def _anchors(rows: DataFrame, rule: PassageRule, slots: int) -> DataFrame:
    """Pairs of equal seeds, and of equal units where seeds are common."""
    # shuffled seeds are most of the disk and not read again
    links = settled(_links(_seeds(rows, rule, slots), rule, slots, True))
    units = _links(_units(links, rule, slots), rule, slots, False)
    return links.where(f"kind <> {_PLACE}").union(units)


def _thinned(pos: np.ndarray, target: np.ndarray, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Anchors without those inside a row of neighbours, but for every ``step``-th."""
    order = np.lexsort((pos, target - pos))
    pos, target = pos[order], target[order]
    opens = np.ones(len(pos), bool)
    opens[1:] = (np.diff(target - pos) != 0) | (np.diff(pos) > 1)
    nth = np.arange(len(pos)) - np.maximum.accumulate(np.where(opens, np.arange(len(pos)), 0))
    kept = opens | np.append(opens[1:], True) | (nth % step == 0)
    return pos[kept], target[kept]


_CHAINS = "doc bigint, source bigint, lo int, hi int, source_lo int, source_hi int, anchors int, margin int"


def _chained(anchors: DataFrame, rule: PassageRule, slots: int) -> DataFrame:
    """Chains of all pairs of documents; a document has its anchors together.

    Common seeds have anchors to two partners only.  So a chain with an anchor of a
    seed of few occurrences goes on to its texts also where the document's own common
    seeds around could make up what it lacks.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _parts(batches):
            columns = []
            for r in held:
                names, pos = _summed(r["docs"]), _summed(r["pos"])
                columns.append((
                    names[_summed(r["doc"])], names[_summed(r["other"])], pos, pos + _summed(r["shift"]),
                    _unpacked(r["length"]).view(np.int64), np.full(len(pos), r["kind"] == _FEW),
                ))
            doc, source, pos, target, length, few = (np.concatenate(c) for c in zip(*columns))
            order = np.lexsort((target, pos, source, doc))
            doc, source, pos, target, length, few = (c[order] for c in (doc, source, pos, target, length, few))
            names, number = np.unique(doc, return_inverse=True)
            place = number.astype(np.int64) << 32 | pos
            common = np.unique(place[~few & (length == rule.size)])

            def around(lo, hi):
                return np.searchsorted(common, hi + rule.wide) - np.searchsorted(common, lo - rule.wide)

            head = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (source[1:] != source[:-1])))
            most = np.add.reduceat(length - rule.size + 1, head)
            near = np.maximum.reduceat(np.where(few, around(place, place + length), 0), head)
            rows = []
            tail = np.append(head, len(doc))
            wanted = most + near >= rule.shared
            # anchors on one diagonal without wide gaps are one chain
            shift = target - pos
            gap = np.diff(pos, prepend=0)
            gap[head] = 0
            plain = (np.minimum.reduceat(shift, head) == np.maximum.reduceat(shift, head)) & (np.maximum.reduceat(gap, head) <= rule.max_gap)
            one = np.flatnonzero(wanted & plain)
            lo, hi = pos[head], np.maximum.reduceat(pos + length, head)
            base = place[head]
            rare, sure = np.logical_or.reduceat(few, head), most >= rule.shared
            kept = one[sure[one] | rare[one] & (most[one] + around(base[one], base[one] - lo[one] + hi[one]) >= rule.shared)]
            first = head[kept]
            margins = np.where(sure[kept], rule.margin, rule.wide)
            rows += zip(*(c.tolist() for c in (
                doc[first], source[first], lo[kept], hi[kept], lo[kept] + shift[first], hi[kept] + shift[first],
                (tail[kept + 1] - first), margins,
            )))
            for g in np.flatnonzero(wanted & ~plain).tolist():
                own = slice(tail[g], tail[g + 1])
                p, t, n, known = pos[own], target[own], length[own], few[own]
                # a unit is its first and its last k-mer
                ends = n - rule.size
                points = np.unique(np.append(p << 32 | t, (p + ends) << 32 | (t + ends)))
                start = int(place[tail[g]] - p[0])
                made = chains(*_thinned(points >> 32, points & 0xFFFFFFFF), rule)
                lo, hi = np.array(made)[:, :2].T
                held_by, rare_by = _within(made, p, t, n, known, rule)
                near_by = around(start + lo, start + hi)
                margins = np.where(rare_by & (held_by + near_by >= rule.shared), rule.wide, 0)
                margins[held_by >= rule.shared] = rule.margin
                for j in np.flatnonzero(margins).tolist():
                    rows.append((int(doc[own.start]), int(source[own.start]), *map(int, made[j]), int(margins[j])))
            yield _table(rows, _CHAINS)

    return _gathered(anchors, slots).mapInArrow(build, _CHAINS)


#: Anchors that are held against chains at a time.
_AT_ONCE = 1 << 21


def _within(made: list[tuple], pos, target, length, few, rule: PassageRule) -> tuple[np.ndarray, np.ndarray]:
    """K-mers of the anchors within each chain, and whether there is one of few; ``pos`` is in order."""
    lo, hi, source_lo, source_hi, _ = np.array(made).T
    first, last = np.searchsorted(pos, lo), np.searchsorted(pos, hi)
    total = np.append(0, np.cumsum(last - first))
    many, rare = np.zeros(len(made), np.int64), np.zeros(len(made), bool)
    i = 0
    while i < len(made):
        j = max(i + 1, int(np.searchsorted(total, total[i] + _AT_ONCE, side="right")) - 1)
        counts = last[i:j] - first[i:j]
        which, at = np.repeat(np.arange(i, j), counts), np.repeat(first[i:j], counts) + _ranges(counts)
        own, there, n = pos[at], target[at], length[at]
        inside = (own + n <= hi[which]) & (there >= source_lo[which]) & (there + n <= source_hi[which])
        which, at = which[inside], at[inside]
        np.add.at(many, which, length[at] - rule.size + 1)
        rare[which[few[at]]] = True
        i = j
    return many, rare


def _blocks(rows: DataFrame, needed: DataFrame, rule: PassageRule) -> DataFrame:
    """(doc, block, words): 32-bit hashes of the words of the needed blocks."""
    joined = rows.join(needed, "doc").select("doc", "text", "blocks")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                w = words(piece.column("text"))
                short = (w.hash >> _U(32)).astype(np.uint32)
                out: list[tuple] = []
                for i, (doc, blocks) in enumerate(zip(piece.column("doc").to_pylist(), piece.column("blocks").to_pylist())):
                    own = short[w.first[i] : w.first[i + 1]]
                    for b in blocks:
                        if 0 <= b * rule.block < len(own):
                            out.append((doc, b, own[b * rule.block : (b + 1) * rule.block].tobytes()))
                if out:
                    kinds = [pa.int64(), pa.int32(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc", "block", "words"]
                    )

    # rows with one id and different texts: any of them
    found = joined.mapInArrow(build, "doc bigint, block int, words binary")
    return found.dropDuplicates(["doc", "block"])


def extend(a: list, b: list, step: int, i: int, j: int, lo: tuple[int, int], hi: tuple[int, int]) -> int:
    """Words by which a match ending at (i, j) goes on in one direction.

    Words beyond it are compared in place; one that differs costs two, and the
    search ends four below the best sum.
    """
    best = total = length = 0
    n = 0
    while lo[0] <= i < hi[0] and lo[1] <= j < hi[1] and total > best - 4:
        total += 1 if a[i] == b[j] else -2
        n += 1
        if total > best:
            best, length = total, n
        i, j = i + step, j + step
    return length


def _aligned(found: DataFrame, rows: DataFrame, rule: PassageRule) -> DataFrame:
    chain = F.xxhash64("doc", "source", "lo", "hi", "source_lo", "source_hi").alias("chain")
    found = found.select(chain, "*")
    mine = found.select("chain", F.lit(0).alias("side"), "doc", F.col("lo").alias("a"), F.col("hi").alias("b"), "margin")
    theirs = found.select("chain", F.lit(1), "source", "source_lo", "source_hi", "margin")
    sides = mine.union(theirs)
    first = F.floor(F.greatest(F.col("a") - F.col("margin"), F.lit(0)) / rule.block).cast("int")
    last = F.floor((F.col("b") + F.col("margin")) / rule.block).cast("int")
    sides = sides.select("chain", "side", "doc", F.explode(F.sequence(first, last)).alias("block"))
    # distinct first: thousands of chains may share a source
    needed = sides.select("doc", "block").distinct().groupBy("doc").agg(F.collect_list("block").alias("blocks"))
    blocks = settled(_blocks(rows, needed, rule))
    schema = (
        "doc_id bigint, start bigint, end bigint, source_id bigint, source_start bigint, source_end bigint, "
        "distance bigint, similarity double"
    )
    names = [f.split()[0] for f in schema.split(", ")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = _align_batch(batch, rule)
            if out:
                kinds = [pa.int64()] * 7 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    # the words of some of the chains at a time, to hold no more of them on disk
    parts = []
    for share in range(rule.shares):
        own = F.pmod("chain", F.lit(rule.shares)) == share
        texts = sides.where(own).join(blocks, ["doc", "block"]).groupBy("chain").agg(
            F.collect_list(F.struct("side", "block", "words")).alias("parts")
        )
        parts.append(settled(found.where(own).join(texts, "chain").mapInArrow(build, schema)))
    return reduce(DataFrame.union, parts)


def alike(a: list, b: list, rule: PassageRule) -> list[tuple[int, int, int, int]]:
    """(lo, hi, lo in b, hi in b) of disjoint stretches that are passages.

    An optimal alignment is cut at the longest stretch between two equal words
    in which four words agree for each that does not (for similarity 0.8); what
    is left on both sides is searched in the same way.
    """
    steps = alignment(a, b)
    cost = rule.similarity / (1 - rule.similarity)
    found, todo = [], [(0, len(steps))]
    places = [(0, 0)]
    for step in steps:
        i, j = places[-1]
        places.append((i + (step != "b"), j + (step != "a")))
    while todo:
        lo, hi = todo.pop()
        if hi - lo < rule.least:
            continue
        total = np.concatenate([[0.0], np.cumsum([1.0 if s == "=" else -cost for s in steps[lo:hi]])])
        # the last place from which the sum is as high as at x
        highest = np.maximum.accumulate(total[::-1])[::-1]
        ends = np.searchsorted(-highest, -total + 1e-6, side="right") - 1
        x = int((ends - np.arange(len(total))).argmax())
        x, y = lo + x, lo + int(ends[x])
        while x < y and steps[x] != "=":
            x += 1
        while x < y and steps[y - 1] != "=":
            y -= 1
        (i, j), (k, m) = places[x], places[y]
        if y - x < rule.least:
            continue
        if min(k - i, m - j) >= rule.least:
            found.append((i, k, j, m))
        todo += [(lo, x), (y, hi)]
    return found


def reaches(a: list, b: list, edits: int) -> list[tuple[int, int, int]]:
    """(edits, words of a, words of b): the furthest beginnings on each diagonal by number of edits."""
    out, last = [], {}
    for e in range(edits + 1):
        now = {}
        for d in range(-e, e + 1):
            # words of b; those of a are d more
            j = max(last.get(d, -2) + 1, last.get(d - 1, -1), last.get(d + 1, -2) + 1) if e else 0
            j = min(j, len(b), len(a) - d)
            if j < 0 or j + d < 0:
                continue
            while j < len(b) and j + d < len(a) and a[j + d] == b[j]:
                j += 1
            now[d] = j
            out.append((e, j + d, j))
        last = now
    return out


def widened(a: list, b: list, core: tuple, limits: tuple, rule: PassageRule) -> tuple[int, int, int, int] | None:
    """The passage around a chain with most edits to spare, if there is one."""
    lo, hi, lo_b, hi_b = core
    distance = edit_distance(a[lo:hi], b[lo_b:hi_b])
    longest = max(hi - lo, hi_b - lo_b) + 2 * rule.margin
    spare = min(int((1 - rule.similarity) * longest) - distance, rule.least // 4)
    if spare < 0 or hi - lo >= 2 * rule.least:
        return None
    back = np.array(reaches(a[limits[0] : lo][::-1], b[limits[2] : lo_b][::-1], spare))[:, None]
    on = np.array(reaches(a[hi : limits[1]], b[hi_b : limits[3]], spare))[None]
    size_a, size_b = hi - lo + back[..., 1] + on[..., 1], hi_b - lo_b + back[..., 2] + on[..., 2]
    left = (1 - rule.similarity) * np.maximum(size_a, size_b) - distance - back[..., 0] - on[..., 0]
    left[np.minimum(size_a, size_b) < rule.least] = -1
    i, j = np.unravel_index(left.argmax(), left.shape)
    if left[i, j] < -1e-9:
        return None
    return lo - int(back[i, 0, 1]), hi + int(on[0, j, 1]), lo_b - int(back[i, 0, 2]), hi_b + int(on[0, j, 2])


def alignment(a: list, b: list) -> list[str]:
    """Steps of an optimal alignment: ``=``, ``x`` (replaced), ``a`` or ``b`` (in one only)."""
    full = (1 << len(a)) - 1
    where: dict = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    plus, minus, columns = full, 0, []
    for c in b:
        equal = where.get(c, 0)
        vertical = equal | minus
        equal |= ((equal & plus) + plus) ^ plus
        up, down = minus | ~(equal | plus) & full, plus & equal
        up, down = (up << 1 | 1) & full, (down << 1) & full
        plus, minus = down | ~(vertical | up) & full, up & vertical
        columns.append((plus, minus))
    i, j, steps = len(a), len(b), []
    while i and j:
        if columns[j - 1][0] >> (i - 1) & 1:
            i -= 1
            steps.append("a")
            continue
        j -= 1
        if j and columns[j - 1][1] >> (i - 1) & 1:
            steps.append("b")
        else:
            i -= 1
            steps.append("=" if a[i] == b[j] else "x")
    steps += ["a"] * i + ["b"] * j
    return steps[::-1]


def _common_runs(a: list, b: list, size: int) -> int:
    """K-mers of ``a`` that ``b`` has as well."""
    theirs = set(zip(*(b[i:] for i in range(size))))
    return sum(k in theirs for k in zip(*(a[i:] for i in range(size))))


def agree(a: list, b: list, least: int) -> bool:
    """Whether an alignment can find ``least`` equal words: their longest common subsequence."""
    where: dict = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    equal = [where[c] for c in b if c in where]
    if len(equal) < least:
        return False
    full = (1 << len(a)) - 1
    left = full
    for e in equal:
        taken = left & e
        left = (left + taken | left - taken) & full
    return len(a) - left.bit_count() >= least


def _align_batch(batch: pa.RecordBatch, rule: PassageRule) -> list[tuple]:
    """Passages of chains with their words, by block and side."""
    parts = batch.column("parts")
    held = parts.flatten()
    side, block = (np.asarray(held.field(c)) for c in ("side", "block"))
    chain = np.repeat(np.arange(len(parts)), np.diff(np.asarray(parts.offsets)))
    order = np.lexsort((block, side, chain))
    text = held.field("words")
    _, offsets, data = text.buffers()
    ends = np.frombuffer(offsets, np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64) // 4
    many = np.diff(ends)[order]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    flat = flat[: len(flat) // 4 * 4].view(np.uint32)[np.repeat(ends[:-1][order], many) + _ranges(many)].tolist()
    # a chain's first side, then its second
    which = (chain * 2 + side)[order]
    begin = np.searchsorted(which, np.arange(2 * len(parts) + 1))
    cuts = np.append(0, np.cumsum(many))[begin].tolist()
    base = (np.append(block[order], 0)[begin] * rule.block).tolist()
    begin = begin.tolist()
    out = []
    for i, r in enumerate(batch.drop_columns(["parts"]).to_pylist()):
        x = 2 * i
        if begin[x] < begin[x + 1] < begin[x + 2]:
            out += _align(r, flat[cuts[x] : cuts[x + 1]], flat[cuts[x + 1] : cuts[x + 2]], base[x], base[x + 1], rule)
    return out


def _align(r: dict, a: list, b: list, base_a: int, base_b: int, rule: PassageRule) -> list[tuple]:
    """Passages of a chain; ``a`` and ``b`` are the words around it, from ``base_a`` and ``base_b`` on."""
    lo, hi = r["lo"] - base_a, r["hi"] - base_a
    lo_b, hi_b = r["source_lo"] - base_b, r["source_hi"] - base_b
    if r["doc"] == r["source"]:
        # copies within one text do not reach into each other
        limit_a, limit_b = max(0, r["source_hi"] - base_a), min(len(b), r["lo"] - base_b)
    else:
        limit_a, limit_b = 0, len(b)
    back = extend(a, b, -1, lo - 1, lo_b - 1, (limit_a, 0), (len(a), len(b)))
    on = extend(a, b, 1, hi, hi_b, (0, 0), (len(a), limit_b))
    whole = (lo - back, hi + on, lo_b - back, hi_b + on)
    rows = [_row(r, whole, a, b, base_a, base_b)] if min(whole[1] - whole[0], whole[3] - whole[2]) >= rule.least else []
    if rows and rows[0][-1] >= rule.similarity:
        return rows
    if r["doc"] == r["source"] and lo + base_a < hi_b + base_b:
        return []
    # too short or too unlike as a whole: aligned with what is around it
    core, margin = (lo, hi, lo_b, hi_b), r["margin"]
    lo, lo_b = max(limit_a, lo - margin), max(0, lo_b - margin)
    hi, hi_b = min(len(a), hi + margin), min(limit_b, hi_b + margin)
    # a passage of the least length and similarity has so many equal words, in order
    if not agree(a[lo:hi], b[lo_b:hi_b], math.ceil(rule.similarity * rule.least - 1e-6)):
        return []
    if margin > rule.margin and _common_runs(a[lo:hi], b[lo_b:hi_b], rule.size) < rule.shared:
        return []
    found = alike(a[lo:hi], b[lo_b:hi_b], rule)
    places = [(i + lo, k + lo, j + lo_b, m + lo_b) for i, k, j, m in found]
    if not places and (place := widened(a, b, core, (lo, hi, lo_b, hi_b), rule)):
        places = [place]
    rows = [_row(r, place, a, b, base_a, base_b) for place in places]
    return [row for row in rows if row[-1] >= rule.similarity]


#: Edits up to which the distance is sought edit by edit.
_FEW_EDITS = 12


def _distance(a: list, b: list) -> int:
    """Edit distance; a small one by the furthest words that each number of edits reaches."""
    i, most = 0, min(len(a), len(b))
    while i < most and a[i] == b[i]:
        i += 1
    j = 0
    while j < most - i and a[-1 - j] == b[-1 - j]:
        j += 1
    # equal beginnings and ends have no part in it
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    few = min(_FEW_EDITS, max(len(a), len(b)) // 16)
    if abs(len(a) - len(b)) <= few:
        last, goal = {}, len(a) - len(b)
        for edits in range(few + 1):
            now = {}
            for d in range(-edits, edits + 1):
                j = max(last.get(d, -2) + 1, last.get(d - 1, -1), last.get(d + 1, -2) + 1) if edits else 0
                j = min(j, len(b), len(a) - d)
                if j < 0 or j + d < 0:
                    continue
                end = min(len(b), len(a) - d)
                while j < end and a[j + d] == b[j]:
                    j += 1
                now[d] = j
            if now.get(goal, -1) >= len(b):
                return edits
            last = now
    return edit_distance(a, b)


def _row(r: dict, place: tuple[int, int, int, int], a: list, b: list, base_a: int, base_b: int) -> tuple:
    lo, hi, lo_b, hi_b = place
    mine, theirs = a[lo:hi], b[lo_b:hi_b]
    distance = 0 if mine == theirs else _distance(mine, theirs)
    similarity = 1 - distance / max(len(mine), len(theirs))
    return (
        r["doc"], lo + base_a, hi + base_a, r["source"], lo_b + base_b, hi_b + base_b, distance, similarity,
    )


def repeated_passages(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", rule: PassageRule = EVERY_SEED
) -> DataFrame:
    """A row per passage of a document that an earlier place holds as well.

    doc_id, start, end: the words (from 0, end exclusive); source_id,
    source_start, source_end: the earlier place, in a document of smaller id
    or before it in the same one; distance in words and similarity.  Equal
    words of one document with several sources give the most similar, then
    the smallest one.  NULL and short texts and rows without an id hold no passage;
    repeated rows of one id are one document.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.where("doc is not null and text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spark = rows.sparkSession
    slots = size // rule.part_bytes + min(24, int(spark.conf.get("spark.sql.shuffle.partitions")))
    chained = settled(_chained(_anchors(rows, rule, slots), rule, slots))
    release(spark)
    found = _aligned(chained, rows, rule)
    best = F.min_by(
        F.struct("source_id", "source_start", "source_end", "distance", "similarity"),
        F.struct(F.negative("similarity"), "source_id", "source_start", "source_end"),
    )
    return found.groupBy("doc_id", "start", "end").agg(best.alias("best")).select("doc_id", "start", "end", "best.*")
