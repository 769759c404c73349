import base64
import hashlib
import random
import time

import pytest
from llm_rows import by_id

from subsight.llm.bpe import Encoder, RankBitmap, Vocabulary, decode_documents, encode_documents
from subsight.llm.queries import tokenizer

LONG = random.Random(8)
TEXTS = [
    None,
    "",
    "Hello  world's 123\n\n x",
    "a" * 5000,
    "".join(LONG.choice("thenio") for _ in range(20_000)),
    "日本語テキスト 🙂 é",
    " <|endoftext|> ",
    "ab" * 777,
]


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks, pattern = tokenizer()
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def test_ids_and_round_trip(documents, reference):
    ranks, pattern = tokenizer()
    encoded = encode_documents(documents(TEXTS, ("ids", "n_tokens")), ranks, pattern)
    got = by_id(encoded)
    for i, text in enumerate(TEXTS):
        want = reference.encode_ordinary(text or "")
        assert got[i].ids == want and got[i].n_tokens == len(want)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    back = by_id(decode_documents(encoded.select("doc_id", "ids"), ranks))
    assert [back[i].text for i in range(len(TEXTS))] == [t or "" for t in TEXTS]


def plain_bpe(ranks, piece):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_any_order_of_ranks():
    """Vocabularies in which a merge makes a pair of lower rank."""
    draw = random.Random(3)
    for _ in range(60):
        words = {bytes(draw.choices(b"abc", k=draw.randint(2, 5))) for _ in range(25)}
        names = [bytes([b]) for b in range(256)] + draw.sample(sorted(words), len(words))
        ranks = {n: i for i, n in enumerate(names)}
        texts = [bytes(draw.choices(b"abc", k=draw.randint(0, 14))) for _ in range(30)] + [b"a" * 9, b""]
        ids, bounds = Vocabulary(ranks).encode_all(texts)
        for i, text in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == plain_bpe(ranks, text), text


def test_bitmap_is_an_ordered_set():
    draw, bitmap, want = random.Random(1), RankBitmap(70_000), set()
    for _ in range(3000):
        value = draw.randrange(70_000)
        if draw.random() < 0.6:
            bitmap.add(value)
            want.add(value)
        elif want:
            low = min(want)
            assert bitmap.first() == low
            bitmap.remove(low)
            want.discard(low)
    assert bitmap.first() == min(want, default=-1)


def test_kept_results_are_bounded(reference):
    ranks, pattern = tokenizer()
    encoder = Encoder(Vocabulary.read(ranks), pattern)
    encoder.BATCH_BYTES, encoder.KEPT_BYTES = 40, 100
    texts = [f"some words {i} and more" for i in range(60)]
    assert encoder.joined_ids(texts) == [",".join(map(str, reference.encode_ordinary(t))) for t in texts]


def test_empty_table(documents):
    assert encode_documents(documents([]), *tokenizer()).count() == 0


def test_long_pre_tokens_take_time_in_proportion():
    """Ranks whose merges make lower ones: each waiting place is taken up once."""
    ranks, _ = tokenizer()
    vocabulary, chance = Vocabulary.read(ranks), random.Random(2)
    word = "".join(chance.choice("ab") for _ in range(32_000)).encode()
    took = []
    for part in (word[:8000], word):
        began = time.perf_counter()
        vocabulary.encode_all([part])
        took.append(time.perf_counter() - began)
    assert took[1] < 9 * took[0] + 0.3
