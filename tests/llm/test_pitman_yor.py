import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_rows import by_id

from subsight.llm.pitman_yor import LmRule, Predictor, Seating, Totals, lm_scores, perplexity, seat

RULE = LmRule(frequent=20, classes=16)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(13)
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    texts = []
    for _ in range(150):
        words = draw.choices(vocabulary, weights, k=draw.randint(0, 60))
        # pairs that a context should learn
        texts.append(" ".join(w + " follower" if w == "w3" else w for w in words).upper())
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, "never seen words"), (903, "w1 " * 20_000)]
    return rows + [(5, texts[5]), (5, texts[5]), (None, "w1 w2")]


def test_counts_and_base_score(documents, rows):
    found = lm_scores(documents(rows, ("copies", "crc", "held")), RULE).collect()
    assert len(found) == len(rows)
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    count = Counter(w for i, own in tokens for w in own if not held[i])
    n, v = sum(count.values()), len(count)
    want = {}
    for i, own in tokens:
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        want[i] = (held[i], len(own), sum(count[w] > 0 for w in own), n, base)
    for r in found:
        assert tuple(r)[1:5] == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4], rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    assert len({r.score for r in found if r.doc_id == 5}) == 1


def test_contexts_help_on_held_out_texts(documents, rows):
    both = {r.held_out: r for r in perplexity(lm_scores(documents(rows[:150]), RULE)).collect()}
    assert both[True].perplexity < both[True].base_perplexity
    assert both[False].perplexity < both[False].base_perplexity


def test_tiny_inputs(documents):
    assert lm_scores(documents([]), RULE).count() == 0
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = by_id(lm_scores(documents([(held, "only held out")]), RULE))[held]
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (4, 0, 0, 0.0)
    assert row.score < 0


def test_seats_follow_the_chinese_restaurant():
    """Mean number of tables against the exact recursion over customers."""
    draw = np.random.Generator(np.random.PCG64(3))
    for count, attract, discount in ((1, 2.0, 0.5), (6, 0.7, 0.5), (7, 3.0, 0.8)):
        chances = {1: 1.0}
        for seated in range(1, count):
            following = Counter()
            for tables, p in chances.items():
                new = attract / (attract + seated - discount * tables)
                following[tables + 1] += p * new
                following[tables] += p * (1 - new)
            chances = following
        mean = sum(t * p for t, p in chances.items())
        got = seat(np.full(20_000, count), np.full(20_000, attract), discount, draw).mean()
        assert got == pytest.approx(mean, abs=0.05)


def test_probabilities_add_up():
    draw = np.random.Generator(np.random.PCG64(4))
    size, parent = 300, np.arange(RULE.contexts) % RULE.classes
    word = draw.zipf(1.5, 6000) % size
    context = draw.integers(0, RULE.contexts, 6000)
    key, count = np.unique(word * RULE.contexts + context, return_counts=True)
    names, word = np.unique(key // RULE.contexts, return_inverse=True)
    made = Seating(word, key % RULE.contexts, count, parent, RULE)
    base, totals = (1 - RULE.unseen) / len(names), made.totals()
    for _ in range(4):
        for _ in range(3):
            made.sweep(totals, base, draw)
        totals = made.totals()
    predictor = Predictor(made, totals, base, draw)
    every = np.append(np.arange(len(names)), -1)
    for c in (0, 3, RULE.classes + 1, RULE.contexts - 1):
        p = predictor.probability(every, np.full(len(every), c), parent)
        assert (p > 0).all() and p.sum() == pytest.approx(1, abs=1e-9)


def test_totals_are_sums_over_words():
    made = Seating(np.array([0, 0, 1]), np.array([2, 20, 20]), np.array([4, 1, 3]), np.arange(RULE.contexts) % 16, RULE)
    totals = made.totals()
    assert totals.customers[20] == 4 and totals.customers[-1] == totals.tables[RULE.contexts : -1].sum()
    assert len(Totals.empty(RULE).tables) == RULE.contexts + RULE.classes + 1


def test_parent_of_a_frequent_word_is_its_own_class(documents, monkeypatch):
    import pyarrow as pa

    from subsight.llm import pitman_yor
    from subsight.llm.text import words

    seen = []
    made = pitman_yor._parents
    monkeypatch.setattr(pitman_yor, "_parents", lambda *a: seen.append((a[0], made(*a))) or seen[-1][1])
    names = ["walking", "Talking", "cars", "bars", "x"]
    lm_scores(documents([(i, " ".join(names)) for i in range(8)]), RULE)
    (known, parent), c = seen[0], RULE.classes
    t = pitman_yor.tokens(pa.array(names), c)
    first = t.first[:-1]
    numbers = known.of(words(pa.array(names)).hash)
    assert (numbers > 1).all() and parent[c + numbers].tolist() == t.kind[first].tolist()
    assert parent[c + numbers[0]] == parent[c + numbers[1]] and parent[c + 1] == 0


def test_every_word_is_a_context_of_its_own(documents):
    """Beyond the frequent words too: what follows a rare word is learned of that word alone."""
    draw = random.Random(5)
    fill = [f"f{i}" for i in range(30)]
    # pairs of words of one ending, so of one class: each has its own follower
    follows = {f"p{i:03}end": f"q{i:03}end" for i in range(120)}
    texts = []
    for _ in range(400):
        first = draw.choice(list(follows))
        texts.append(" ".join([*draw.choices(fill, k=12), first, follows[first], *draw.choices(fill, k=2)]))
    held = [i for i in range(2000, 4000) if zlib.crc32(str(i).encode()) % 5 == 1]
    pairs = list(follows.items())
    right = [(held[i], " ".join(pairs[i])) for i in range(60)]
    wrong = [(held[100 + i], f"{pairs[i][0]} {pairs[i + 1][1]}") for i in range(60)]
    seen = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 != 1]
    score = {r.doc_id: r.score for r in lm_scores(documents([*zip(seen, texts), *right, *wrong]), RULE).collect()}
    means = [sum(score[i] for i, _ in rows) / len(rows) for rows in (right, wrong)]
    assert means[0] > means[1] + 1


def test_scores_of_certain_seats_by_hand(documents):
    """Words that occur once have one table everywhere, so that scores follow without a draw."""
    rule = LmRule(frequent=2, classes=16)
    learned = "alpha beta gamma delta omega".split()
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1]
    asked = [learned, ["beta", "alpha"], ["gamma", "gamma", "new"], ["new", "delta"], ["omega"], []]
    kinds = {w: 1 + (ord(w[-1]) * 31 + ord(w[-2]) * 7) % 15 for w in [*learned, "new"]} | {None: 0}
    pairs = set(zip([None, *learned], [*learned, None]))
    nodes = {(kinds[u], w) for u, w in pairs}
    (d0, d1, d2), (s0, s1, s2) = rule.discount, rule.strength
    n = len(learned) + 1
    # a root customer for each class that a word was seen in
    in_class = {w: sum(x == w for _, x in nodes) for w in [*learned, None]}
    assert set(in_class.values()) == {1}

    def chance(u, w):
        base = (1 - rule.unseen) / n if w in in_class else rule.unseen
        p = ((w in in_class) * (1 - d0) + (s0 + d0 * n) * base) / (s0 + n)
        mine = sum(k == kinds[u] for k, _ in nodes)
        p = (((kinds[u], w) in nodes) * (1 - d1) + (s1 + d1 * mine) * p) / (s1 + mine)
        once = u is None or u in learned
        return (((u, w) in pairs) * (1 - d2) + (s2 + d2 * once) * p) / (s2 + once)

    rows = [(next(i for i in range(200) if i not in held), " ".join(learned)), *zip(held, map(" ".join, asked))]
    found = by_id(lm_scores(documents(rows), rule))
    for i, words in zip(held, asked):
        want = sum(math.log10(chance(u, w)) for u, w in zip([None, *words], [*words, None]))
        assert found[i].score == pytest.approx(want, rel=1e-9), words


def test_rare_contexts_are_summed_over_all_parts(documents):
    """A context's words may be dealt to any part: scores do not depend on how many there are, but for the draws."""
    draw = random.Random(8)
    fill = [f"f{i}" for i in range(300)]
    rows = [(i, " ".join(draw.choices(fill, k=40))) for i in range(120)]
    one = by_id(lm_scores(documents(rows), LmRule(frequent=5, classes=16, tokens_per_part=10**9)))
    many = by_id(lm_scores(documents(rows), LmRule(frequent=5, classes=16, tokens_per_part=200)))
    assert one.keys() == many.keys()
    for i, r in one.items():
        assert tuple(r)[1:5] == tuple(many[i])[1:5] and many[i].score == pytest.approx(r.score, rel=0.03)
