import random

import pytest
from llm_rows import by_id

from subsight.llm.graph import components
from subsight.llm.near_dup import NearDup, drop_near_duplicates, near_duplicates


def brute(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        own = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        sets[i] = own
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            o = len(sets[i] & sets[j])
            if i < j and o and 100 * o >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_copies(draw, base, count, edits):
    out = []
    for _ in range(count):
        w = base.split()
        for _ in range(draw.randint(0, edits)):
            w[draw.randrange(len(w))] = f"new{draw.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_matches_brute_force(documents):
    draw = random.Random(9)
    vocabulary = [f"w{i}" for i in range(200)]
    texts = [None, "", " \n", "a b", "A B", "b a", "one two three four five", "one two three four five"]
    for size in (30, 80, 150):
        base = " ".join(draw.choices(vocabulary, k=size))
        texts += [base, base.upper()] + near_copies(draw, base, 40, 4)
    texts += [" ".join(draw.choices(vocabulary, k=40)) for _ in range(30)]
    texts.append(" ".join(draw.choices(vocabulary, k=30_000)))
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    got = by_id(near_duplicates(documents(rows, ("node", "key", "subs", "component"))))
    want = brute(rows)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_drop_keeps_one_of_each_group(documents):
    docs = documents([(3, "a b c d e f"), (1, "A b c d e f"), (7, None), (8, ""), (None, "a b c d e f"), (1, "A b c d e f")])
    kept = [r.doc_id for r in drop_near_duplicates(docs).collect()]
    assert sorted(kept, key=str) == [1, 1, 7, 8, None]


def test_dropping_with_clashing_names(documents):
    docs = documents([(3, "a b c d e f"), (1, "A b c d e f")], ("_dropped_id", "dropped_id", "Dropped_Id_"[:-1] + "2"))
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0


def test_miss_bound_of_the_tables():
    rule = NearDup()
    assert 2 * (1 - 0.85**rule.width) ** rule.count < 2e-5


@pytest.mark.parametrize("edges", [[], [(1, 1), (None, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    real = [e for e in edges if None not in e and e[0] != e[1]]
    parent = {x: x for e in real for x in e}
    for _ in range(len(parent)):
        for a, b in real:
            low = min(parent[a], parent[b])
            parent[a] = parent[b] = low
    assert got == parent
