import numpy as np
import pyarrow as pa

from subsight.llm.text import pieces, shingles, words

TEXTS = ["Hello  World\tx", None, "", "  ", "a", "A\n", "é b É", "x y z a b c", "hello world", "tail "]


def test_words_are_those_of_bytes_split():
    w = words(pa.array(TEXTS))
    for d, text in enumerate(TEXTS):
        own = range(w.first[d], w.first[d + 1])
        assert [bytes(w.data[w.start[i] : w.end[i]]) for i in own] == (text or "").encode().lower().split()
    assert w.hash[w.first[0]] == w.hash[w.first[8]]


def test_words_of_sliced_arrays():
    column = pa.array(["one two", None, "three", "four five"]).slice(1, 3)
    w = words(column)
    assert np.diff(w.first).tolist() == [0, 1, 2]
    assert w.hash[1] == words(pa.array(["four"])).hash[0]


def test_short_documents_have_one_shingle():
    w = words(pa.array(["a b", "a b", "b a", "a b c d e f", "", "a"]))
    values, bounds = shingles(w.hash, w.first, 5)
    assert np.diff(bounds).tolist() == [1, 1, 1, 2, 0, 1]
    assert values[0] == values[1] != values[2]


def test_pieces_keep_documents_whole():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 50, "y" * 500, None, "z"], "n": [1, 2, 3, 4]})
    parts = list(pieces(batch, limit=100))
    assert sum(p.num_rows for p in parts) == 4 and len(parts) >= 2
    assert [t for p in parts for t in p.column("text").to_pylist()] == ["x" * 50, "y" * 500, None, "z"]
