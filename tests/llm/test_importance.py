import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from subsight.llm import importance as im

ITEM = "item_id bigint, text string"


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features_of(text):
    words = words_of(text)
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(docs, target):
    """The contract, read literally."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = [0] * 10000, [0] * 10000
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in features_of(text):
                counts[bucket(f)] += 1
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (big_s + 10000) / ((a + 1) * (big_t + 10000)))) for a, b in zip(s, t)]
    rows = {}
    for doc_id, text in docs:
        found = features_of(text)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows[doc_id] = [len(found), weight, score, None, len(words_of(text)) >= 20]
    may = sorted((-r[2], i) for i, r in rows.items() if r[4])
    for rank, (_, i) in enumerate(may[: 5 * len(may) // 100], 1):
        rows[i][3] = rank
    return {i: tuple(r[:4]) for i, r in rows.items()}


def some_texts():
    chance = np.random.default_rng(5)
    names = ["alpha", "Beta", "été", "x1", "Ünder", "中文", "long" * 40, "a-b", "q\x00r", "İ", "9"]
    texts = [" ".join(chance.choice(names, size=chance.integers(0, 60))) for _ in range(120)]
    return [*texts, "", None, "...", "one", "One two", "é" * 500, texts[0], " ".join(["word"] * 5000)]


def test_equals_the_contract(spark, documents):
    docs = list(enumerate(some_texts()))
    target = ["alpha beta été x1", None, "", "x1 x1 9"]
    table = documents([(i, t) for i, t in docs], extra=("weight", "score", "rank", "_may", "n_words", "bucket"))
    items = spark.createDataFrame(list(enumerate(target)), ITEM)
    found = {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in im.importance_resample(table, items).collect()}
    assert found == plain(docs, target)
    drawn = im.draw(table, items)
    assert drawn.columns == table.columns and drawn.count() == sum(r[3] is not None for r in found.values()) > 0


def test_joined_crcs():
    chance = np.random.default_rng(2)
    left = [bytes(chance.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 5, 63, 64, 200, 4096)]
    right = [bytes(chance.integers(0, 256, n, dtype=np.uint8)) for n in (1, 2, 63, 64, 65, 1000, 70001)]
    pairs = [(a, b) for a in left for b in right]
    crc = np.array([zlib.crc32(a) for a, _ in pairs], np.uint32)
    added = np.array([zlib.crc32(b) for _, b in pairs], np.uint32)
    joined = im.append_crc(crc, added, np.array([len(b) for _, b in pairs]))
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_runs_stay_inside_their_text():
    found = im.features(pa.array(["a b", None, "", "c", "d e f g"]))
    assert found.occurrences().tolist() == [3, 0, 0, 1, 9]
    assert [len(r.run) for r in found.runs] == [7, 4, 2]


@pytest.mark.parametrize("percent,drawn", [(0, 0), (100, 4)])
def test_share_ties_and_nulls(spark, percent, drawn):
    long = " ".join(["w"] * 20)
    rows = [(None, long), (7, long), (7, long), (3, long), (4, "w " * 19)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    target = spark.createDataFrame([], ITEM)
    found = im.importance_resample(docs, target, percent=percent).collect()
    ranks = sorted(r["rank"] for r in found if r["rank"] is not None)
    assert len(found) == 5 and ranks == list(range(1, drawn + 1))
    assert all(r["rank"] is None for r in found if r["doc_id"] == 4)
    if drawn:
        order = sorted((-r["score"], r["doc_id"] is not None, r["doc_id"] or 0) for r in found if r["rank"])
        assert [(-r["score"], r["doc_id"] is not None, r["doc_id"] or 0) for r in sorted(found, key=lambda r: r["rank"] or 99) if r["rank"]] == order


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert im.importance_resample(docs, spark.createDataFrame([(1, "a b")], ITEM)).collect() == []
