import hashlib
import random

import numpy as np
import pytest
from llm_rows import by_id

from subsight.llm.edit_embedding import (
    EditRule, Embedder, edit_distance, edited_fingerprints, fingerprint_documents, from_hex, likeness, near_pairs, to_hex,
)

DRAW = random.Random(12)


def prose(size):
    return "".join(DRAW.choice("etaoin shrdlu,é") for _ in range(size))


def test_distance():
    for _ in range(200):
        a, b = ("".join(DRAW.choices("abc", k=DRAW.randint(0, 12))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            old, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        assert edit_distance(a, b) == row[-1]


def test_walk_is_that_of_the_definition():
    rule = EditRule(bins=32, segment=50)
    embedder = Embedder(rule)
    advance, sign = rule.tables()
    texts = [prose(130), "", prose(50), prose(3)]
    for text, got in zip(texts, embedder.bins(texts)):
        from subsight.llm.edit_embedding import _classes

        want = np.zeros(32, int)
        for lo in range(0, len(text), 50):
            part, at, step = _classes(text[lo : lo + 50]), 0, 0
            while at < len(part):
                want[step % 32] += sign[step % len(sign)][part[at]]
                at += advance[step % len(sign)][part[at]]
                step += 1
        assert got.tolist() == want.tolist()


def test_likeness_falls_with_edits():
    base = prose(4000)
    near = []
    for edits in (0, 5, 60, 4000):
        chars = list(base)
        for _ in range(edits):
            at = DRAW.randrange(len(chars))
            if DRAW.random() < 0.5:
                chars.insert(at, DRAW.choice("xyz"))
            else:
                del chars[at]
        prints = Embedder().fingerprints([base, "".join(chars)])
        near.append(float(likeness(prints[:1], prints[1:])[0]))
    assert near[0] == 1 and near[0] > near[1] > near[2] > near[3] and near[1] > 0.8
    assert (from_hex(to_hex(prints)[0]) == prints[0]).all()


@pytest.mark.parametrize("buckets", [1, 5])
def test_edited_documents(documents, buckets):
    texts = [None, "", "a", prose(900), prose(901), prose(40_000), "é🙂x"] + [prose(DRAW.randint(1, 300)) for _ in range(40)]
    rows = [*enumerate(texts), (3, texts[3]), (None, "no id")]
    docs = documents(rows, ("bucket", "follows"))
    out = edited_fingerprints(docs, buckets=buckets).collect()
    assert len(out) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in out), key=key) == sorted(want, key=key)
    one = by_id(out_frame := fingerprint_documents(docs))
    assert all(r.fingerprint == one[r.doc_id].fingerprint for r in out) and out_frame.count() == len(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    long_one = next(r for r in out if r.doc_id == 5)
    assert 0.35 < long_one.near_edited < 0.9 and long_one.near_next < 0.35


def test_near_pairs_are_verified(documents):
    base, other = prose(4000), prose(4000)
    close = base[:1500] + "#" + base[1502:3000] + "@@" + base[3000:]
    rows = [(4, base), (9, close), (2, base), (7, other), (8, None), (None, base), (5, "")]
    found = {(r.a, r.b, r.distance) for r in near_pairs(documents(rows)).collect()}
    assert found == {(2, 9, edit_distance(base, close))}


def test_empty_table(documents):
    assert edited_fingerprints(documents([])).count() == 0
