import random

import numpy as np
import pytest

from subsight.llm.passages import PassageRule, chains, minimisers, repeated_passages
from subsight.llm.text import words

DRAW = random.Random(31)
WORDS = [f"v{i}" for i in range(3000)]


def prose(size):
    return DRAW.choices(WORDS, k=size)


def test_every_window_of_kmers_has_a_seed():
    import pyarrow as pa

    w = words(pa.array([" ".join(prose(300)), "", "a b c", " ".join(prose(12))]))
    doc, pos, seed = minimisers(w.hash, w.first, 6, 16)
    for d in range(4):
        count = max(0, int(w.first[d + 1] - w.first[d]) - 5)
        own = set(pos[doc == d].tolist())
        assert all(own & set(range(i, i + 16)) for i in range(max(0, count - 15)))
        assert bool(own) == (count > 0)
    assert len(seed) == len(pos)


def test_best_chain_matches_brute_force():
    rule = PassageRule(gap_cost=0.1, max_gap=10**6)
    for _ in range(60):
        n = DRAW.randint(1, 8)
        pos, target = (np.array([DRAW.randrange(60) for _ in range(n)]) for _ in range(2))
        best = 0.0
        for mask in range(1, 1 << n):
            own = sorted((int(pos[i]), int(target[i])) for i in range(n) if mask >> i & 1)
            if all(a < c and b < d for (a, b), (c, d) in zip(own, own[1:])):
                gaps = sum(c - a + d - b for (a, b), (c, d) in zip(own, own[1:]))
                best = max(best, rule.size * len(own) - rule.gap_cost * gaps)
        found = chains(pos, target, rule)
        assert sum(c[4] for c in found) == n
        first = found[0]
        score = rule.size * first[4] - rule.gap_cost * (first[1] - first[0] - 6 + first[3] - first[2] - 6)
        assert score == pytest.approx(best)


@pytest.fixture(scope="module")
def planted():
    passage, fuzzy = prose(70), prose(120)
    changed = list(fuzzy)
    for at in (20, 55, 90):
        changed[at] = "other"
    del changed[70]
    texts = {
        1: prose(40) + passage + prose(30),
        2: prose(10) + fuzzy + prose(10),
        4: prose(300),
        6: prose(25) + passage + prose(5),
        7: changed + prose(60),
        8: [w.upper() for w in passage],
        9: passage[:30] + prose(100),
        10: (own := prose(60)) + prose(20) + own,
        12: None,
        13: ["same"] * 500,
        14: prose(20_000) + fuzzy,
        15: ["one", "two"],
    }
    return {i: " ".join(t) if t is not None else None for i, t in texts.items()}


def test_planted_passages_are_found(documents, planted):
    rows = [*planted.items(), (None, planted[1]), (15, "one two"), (20, planted[4]), (21, planted[4])]
    out = repeated_passages(documents(rows, ("seed", "pos", "source", "block"))).collect()
    pairs = {(r.doc_id, r.source_id) for r in out if r.doc_id != 13}
    assert {(6, 1), (8, 1), (7, 2), (14, 2), (10, 10), (20, 4), (21, 4)} <= pairs
    assert not {d for d, _ in pairs} & {1, 2, 4, 9, 12, 15}
    split = {i: (t or "").lower().split() for i, t in rows if i is not None}
    for r in out:
        assert r.end - r.start >= 50 and r.similarity >= 0.8
        assert (r.source_id, r.source_start) < (r.doc_id, r.start)
        if r.distance == 0:
            assert split[r.doc_id][r.start : r.end] == split[r.source_id][r.source_start : r.source_end]
    exact = next(r for r in out if (r.doc_id, r.source_id) == (6, 1))
    assert (exact.start, exact.end) == (25, 95)
    near = next(r for r in out if (r.doc_id, r.source_id) == (7, 2))
    assert near.end - near.start >= 115 and near.distance == 4


def test_anchors_grow_with_copies_only(documents):
    text = " ".join(prose(80))
    out = repeated_passages(documents([(i, text) for i in range(300)])).collect()
    assert {r.doc_id for r in out} == set(range(1, 300)) and len(out) <= 2 * 299


def test_empty_table(documents):
    assert repeated_passages(documents([])).count() == 0


def test_partner_of_a_joined_passage_is_found(documents):
    one, two = prose(30), prose(30)
    copies = [(100 + i, prose(5) + part + prose(5)) for i, part in enumerate([one, two] * 10)]
    rows = [(1, one), (2, two), (10, one + two), (15, one), (16, two), (20, one + two), *copies, (200, one + two)]
    # for seeds of few occurrences, and for common ones
    for chosen in (rows[:6], rows):
        out = repeated_passages(documents([(i, " ".join(t)) for i, t in chosen])).collect()
        pairs = {(r.doc_id, r.source_id) for r in out if r.end - r.start >= 60}
        assert (20, 10) in pairs
    assert {d for d, _ in pairs} >= {20, 200}


def test_an_earlier_document_behind_copies_of_its_own(documents):
    passage = prose(60)
    rows = [(i, passage * 2 + prose(9)) for i in range(12)] + [(50, passage + prose(40) + passage)]
    out = repeated_passages(documents([(i, " ".join(t)) for i, t in rows])).collect()
    assert {r.source_id for r in out if r.doc_id == 50} & set(range(12))


def test_recall_of_short_passages_with_many_edits(documents):
    rows, want, at = [], {}, 0
    for similarity in (0.8, 0.83, 0.9, 0.95):
        for _ in range(40):
            size = DRAW.randint(50, 60)
            passage = prose(size)
            edited, spots = list(passage), DRAW.sample(range(1, size - 1), int(size * (1 - similarity) + 1e-9))
            for spot in sorted(spots, reverse=True):
                kind = DRAW.random()
                if kind < 0.7 or size == 50 or len(edited) <= 50:
                    edited[spot] = "changed"
                else:
                    del edited[spot]
            rows += [(at, prose(40) + passage + prose(40)), (at + 1, prose(70) + edited + prose(30))]
            want[at + 1] = (at, similarity)
            at += 2
    every_fifth = prose(60)
    rows += [(at, every_fifth), (at + 1, prose(20) + [w if i % 5 != 4 else "changed" for i, w in enumerate(every_fifth)] + prose(20))]
    out = repeated_passages(documents([(i, " ".join(t)) for i, t in rows])).collect()
    found = {(r.doc_id, r.source_id) for r in out}
    assert (at + 1, at) in found
    for similarity in (0.8, 0.83, 0.9, 0.95):
        hits = [(d, s) in found for d, (s, near) in want.items() if near == similarity]
        print("recall", similarity, sum(hits), len(hits))
        assert all(hits)


def test_a_link_that_few_rare_seeds_and_many_common_ones_make(documents):
    blocks = [prose(4) for _ in range(8)] + [prose(4), prose(5)]
    one = [w for b in blocks for w in [*b, *prose(1)]][:-1]
    two = [w for b in blocks for w in [*b, *prose(1)]][:-1]
    # all blocks but the last two stand before the one, and between it and the two
    others = [(i, " ".join(w for b in blocks[:8] for w in [*prose(30), *b])) for i in [*range(1, 13), *range(60, 72)]]
    rows = [*others, (50, " ".join(prose(40) + one + prose(40))), (100, " ".join(prose(60) + two + prose(20)))]
    out = repeated_passages(documents(rows)).collect()
    assert (100, 50) in {(r.doc_id, r.source_id) for r in out}


def test_agree_is_the_longest_common_subsequence():
    from subsight.llm.passages import agree

    draw = random.Random(4)
    for _ in range(300):
        a, b = ([draw.randrange(6) for _ in range(draw.randrange(14))] for _ in range(2))
        longest = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                longest[i + 1][j + 1] = longest[i][j] + 1 if x == y else max(longest[i][j + 1], longest[i + 1][j])
        assert agree(a, b, longest[-1][-1]) and not agree(a, b, longest[-1][-1] + 1)


def test_distance_edit_by_edit_is_the_edit_distance():
    from subsight.llm.edit_embedding import edit_distance
    from subsight.llm.passages import _distance

    draw = random.Random(6)
    for size in (0, 1, 5, 60, 400):
        for edits in (0, 1, 2, 7, 12, 13, 30):
            a = [draw.randrange(40) for _ in range(size)]
            b = list(a)
            for _ in range(edits):
                at = draw.randrange(len(b) + 1)
                b[at : at + draw.randrange(2)] = [draw.randrange(40)] * draw.randrange(2)
            assert _distance(a, b) == edit_distance(a, b)


def test_chains_that_cannot_be_passages_are_not_aligned(monkeypatch):
    """Seven shared runs spread over too many other words take no alignment."""
    from subsight.llm import passages

    aligned = []
    monkeypatch.setattr(passages, "alignment", lambda a, b: aligned.append((a, b)) or [])
    rule = passages.EVERY_SEED
    shared = list(range(1, 31))
    spread = [[w for i in range(0, 30, 5) for w in [*shared[i : i + 5], *range(base + i * 20, base + i * 20 + 20)]] for base in (1000, 9000)]
    a, b = spread
    r = dict(doc=2, source=1, lo=0, hi=130, source_lo=0, source_hi=130, margin=rule.margin)
    assert passages._align(r, a, b, 0, 0, rule) == [] and not aligned
    # all fifty words agree, around two that do not
    a = list(range(100, 150))
    r = dict(doc=2, source=1, lo=0, hi=30, source_lo=0, source_hi=30, margin=rule.margin)
    passages._align(r, a, [*a[:30], 7, 8, *a[30:]], 0, 0, rule)
    assert len(aligned) == 1


def test_anchors_within_chains_do_not_depend_on_the_portion(monkeypatch):
    from subsight.llm import passages

    draw = np.random.Generator(np.random.PCG64(2))
    pos = np.sort(draw.integers(0, 60, 200))
    target, length, few = draw.integers(0, 60, 200), draw.integers(4, 9, 200), draw.random(200) < 0.2
    made = [(int(a), int(a + n), int(b), int(b + m), 1) for a, n, b, m in draw.integers(1, 40, (50, 4))]
    rule = passages.EVERY_SEED
    want = []
    for lo, hi, source_lo, source_hi, _ in made:
        inside = (pos >= lo) & (pos + length <= hi) & (target >= source_lo) & (target + length <= source_hi)
        want.append((int((length[inside] - rule.size + 1).sum()), bool(few[inside].any())))
    for portion in (1, 100, 1 << 21):
        monkeypatch.setattr(passages, "_AT_ONCE", portion)
        many, rare = passages._within(made, pos, target, length, few, rule)
        assert list(zip(many.tolist(), rare.tolist())) == want
