import random

import numpy as np
import pytest
from llm_rows import by_id

from subsight.llm.decontaminate import LeakRule, best_stretch, drop_leaks, find_leaks
from subsight.llm.edit_embedding import edit_distance

DRAW = random.Random(21)
WORDS = ["".join(DRAW.choice("etaoinshr") for _ in range(DRAW.randint(2, 9))) for _ in range(900)]


def trimmed(text):
    out = [w.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for w in (text or "").encode().lower().decode().split()]
    return [w for w in out if w]


def brute(docs, items, similarity=0.8):
    found = {}
    for d, text in docs:
        w = trimmed(text)
        for i, item in items:
            goal = trimmed(item)
            if d is None or i is None or not goal or not w:
                continue
            k = int((1 - similarity) * len(goal) + 1e-9)
            near = min(
                edit_distance(goal, w[a:b])
                for a in range(len(w))
                for b in range(a, min(len(w), a + len(goal) + k) + 1)
            )
            if near <= k:
                found[d, i] = near
    return found


def edited(words, edits):
    words = list(words)
    for _ in range(edits):
        at = DRAW.randrange(len(words))
        kind = DRAW.random()
        if kind < 0.4:
            words[at] = DRAW.choice(WORDS)
        elif kind < 0.7:
            words.insert(at, DRAW.choice(WORDS))
        else:
            del words[at]
    return words


@pytest.fixture(scope="module")
def case(spark):
    items = [(i, " ".join(DRAW.choices(WORDS, k=DRAW.choice([3, 5, 8, 20, 35])))) for i in range(25)]
    items += [(90, None), (91, " "), (None, "no id"), (3, items[3][1]), (92, "... ,")]
    docs = []
    for d in range(60):
        words = DRAW.choices(WORDS, k=60)
        if d % 2:
            goal = items[d % 25][1].split()
            at = DRAW.randrange(60)
            words[at:at] = edited(goal, DRAW.randint(0, int(0.2 * len(goal)) + 1))
        docs.append((d, " | ".join([" ".join(words[:30]).upper(), " ".join(words[30:])])))
    docs += [(70, None), (71, ""), (72, items[8][1]), (72, items[8][1]), (73, " ".join(DRAW.choices(WORDS, k=20_000)) + " " + items[9][1])]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, item_id string").repartition(2)
    return docs, items, frame, spark.createDataFrame(items, "item_id bigint, text string")


def test_stretches_match_brute_force():
    for _ in range(100):
        n, width = DRAW.randint(1, 5), DRAW.randint(1, 9)
        item, region = [DRAW.randrange(3) for _ in range(n)], [DRAW.randrange(3) for _ in range(width)]
        distance, begin, end = best_stretch(np.array([item]), np.array([region]))
        best = min(edit_distance(item, region[a:b]) for a in range(width + 1) for b in range(a, width + 1))
        assert distance[0] == best == edit_distance(item, region[begin[0] : end[0]])


def test_matches_brute_force(case):
    docs, items, frame, benchmark = case
    rows = find_leaks(frame, benchmark).collect()
    small = [d for d in docs if d[0] != 73]
    got = {(r.doc_id, r.item_id): r.distance for r in rows if r.doc_id != 73}
    assert got == brute(small, items)
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows})
    assert (73, 9) in {(r.doc_id, r.item_id) for r in rows}
    texts = dict(docs)
    for r in rows:
        if r.distance == 0:
            assert trimmed(texts[r.doc_id][r.start : r.end]) == trimmed(dict(items)[r.item_id])


def test_chunks_of_items_change_nothing(case):
    _, _, frame, benchmark = case
    whole, parts = (find_leaks(frame, benchmark, rule=LeakRule(chunk_bytes=b)).collect() for b in (1 << 20, 900))
    assert sorted(map(tuple, whole)) == sorted(map(tuple, parts))


def test_clean_rows_stay(case):
    docs, items, frame, benchmark = case
    kept = drop_leaks(frame, benchmark)
    assert kept.columns == frame.columns
    leaked = {d for d, _ in brute([d for d in docs if d[0] != 73], items)} | {73}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in leaked)


def test_empty_tables(spark, case, documents):
    _, _, frame, benchmark = case
    assert find_leaks(documents([]), benchmark).count() == 0
    assert find_leaks(frame, benchmark.limit(0)).count() == 0
    assert drop_leaks(frame, benchmark.limit(0)).count() == frame.count()
    assert by_id(drop_leaks(documents([(1, None)]), benchmark))
