import hashlib
import itertools
import json
import random
import time

import pytest
from llm_rows import by_id
from tokenizers import Tokenizer

from subsight.llm import merge_automaton as ma
from subsight.llm.queries import MODEL_FILE, tokenizer


@pytest.fixture(scope="module")
def model():
    return tokenizer(MODEL_FILE)


@pytest.fixture(scope="module")
def library(model):
    return Tokenizer.from_str(model[0].decode())


@pytest.fixture(scope="module")
def encoder(model):
    labels, rules, ids, added = ma.read_model(model[0])
    compiled = ma.Automaton.compile(labels, rules, ids)
    return ma.WordEncoder(ma.Automaton.load(compiled.dump()), model[1], added)


def merged(word, rules, labels):
    """Rules applied one after the other, each from left to right."""
    held = [w for w in word]
    for n, (u, v) in enumerate(rules):
        out = []
        for label in held:
            if out and out[-1] == u and label == v:
                out[-1] = 256 + n
            else:
                out.append(label)
        held = out
    return held


def random_rules(chance, size):
    """Rules over two letters, in any order that makes parts before they are used."""
    labels, rules = [bytes([b]) for b in range(256)], []
    usable = [97, 98]
    while len(rules) < size:
        u, v = chance.choice(usable), chance.choice(usable)
        if labels[u] + labels[v] not in labels:
            rules.append((u, v))
            usable.append(len(labels))
            labels.append(labels[u] + labels[v])
    return labels, rules


@pytest.mark.parametrize("seed", range(25))
def test_accepts_what_the_rules_leave(seed):
    """Every short word over two letters, also with rules that never apply."""
    labels, rules = random_rules(random.Random(seed), 9)
    automaton = ma.Automaton.compile(labels, rules, range(len(labels)))
    words = [bytes(w) for n in range(9) for w in itertools.product(b"ab", repeat=n)]
    for word, ids in zip(words, automaton.encode(words)):
        assert ids.tolist() == merged(word, rules, labels) == (automaton._walk(word) if word else []), (word, rules)


def test_equals_the_library(encoder, library):
    chance = random.Random(3)
    parts = ["a", "b", "the", "ing", " ", "\n", "é", "中", "1", "'s", "<|endoftext|>", "<|", "ational", "0", "-", "​", "\x85", "\x1c", "ǅ", "²", "Ⅳ"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randint(0, 50))) for _ in range(1500)]
    signs = [chr(c) for c in range(0x3200) if not 0xD800 <= c <= 0xDFFF]
    texts += ["".join(f"{c} {c}a " for c in signs[i : i + 50]) for i in range(0, len(signs), 50)]
    joined = encoder.encode(texts)
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert joined == [",".join(map(str, w)) for w in wanted]
    assert [encoder.decode(j) for j in joined] == [library.decode(w, skip_special_tokens=False) for w in wanted] == texts
    # ids that no text has: a part of a character
    assert encoder.decode("96,96,50256") == library.decode([96, 96, 50256], skip_special_tokens=False)


def test_long_words_take_time_in_proportion(encoder, library):
    chance = random.Random(1)
    for word in ("ab" * 30_000, "a" * 60_000, "information" * 5_000, "".join(chance.choice("abc") for _ in range(60_000))):
        took = []
        for part in (word[: len(word) // 4], word):
            began = time.perf_counter()
            joined = encoder.encode([part])[0]
            took.append(time.perf_counter() - began)
            assert joined == ",".join(map(str, library.encode(part, add_special_tokens=False).ids))
        assert took[1] < 12 * took[0] + 0.2


def test_both_walks_agree(encoder, monkeypatch):
    words = ["straightforwardness" * 20, "x", "né" * 300]
    one = encoder.automaton.encode([w.encode() for w in words])
    monkeypatch.setattr(ma.Automaton, "LONG", 1)
    assert [a.tolist() for a in encoder.automaton.encode([w.encode() for w in words])] == [a.tolist() for a in one]


def test_forgetting_changes_nothing(encoder, monkeypatch):
    texts = [f"word{i} other{i % 7} <|endoftext|>" for i in range(300)]
    wanted = encoder.encode(texts)
    monkeypatch.setattr(ma.WordEncoder, "KEPT_BYTES", 50)
    monkeypatch.setattr(ma.WordEncoder, "BATCH_BYTES", 20)
    assert encoder.encode(texts) == wanted


def test_documents(documents, model, library):
    texts = ["The café.", None, "", "The café.", "  \n\t", "a<|endoftext|>b", "long " * 40_000]
    table = documents(texts, extra=("ids", "n_tokens"))
    encoded = ma.tokenize_documents(table, *model)
    found = by_id(encoded)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        row = found[i]
        assert (row["n_tokens"], row["ids"]) == (len(ids), ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    decoded = by_id(ma.detokenize(encoded, *model))
    assert {i: r["text"] for i, r in decoded.items()} == {i: t or "" for i, t in enumerate(texts)}
    assert ma.tokenize_documents(table.limit(0), *model).collect() == []


def test_other_models_are_refused(model):
    held = json.loads(model[0])
    for change in ({"normalizer": {"type": "Lowercase"}}, {"model": held["model"] | {"unk_token": "<|endoftext|>"}}):
        with pytest.raises(ValueError, match="byte-level"):
            ma.read_model(json.dumps(held | change).encode())
    twice = held["model"] | {"merges": [held["model"]["merges"][0]] * 2}
    with pytest.raises(ValueError, match="again"):
        ma.read_model(json.dumps(held | {"model": twice}).encode())
