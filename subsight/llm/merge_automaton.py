"""BPE by a tokenization automaton, built merge by merge.

The automaton reads tokens, not bytes: it accepts exactly the sequences that the
merge rules can leave behind.  It begins with one state and a loop for each
byte.  The gadget of a rule ``u v -> uv`` splits the state that ``u`` leads to:
the copy has no arc ``v`` any more, and wherever ``u`` could be read, ``uv`` can
now be read as well and leads where ``v`` led.  Rules in order make the
automaton of the whole list.  It is deterministic, and of a text's many
segmentations it accepts one.

Two facts keep it small.  All arcs of a label lead to one state, so states are
one per label at most.  A state lacks only what gadgets took away, and taking
away ``v`` also takes what is later built on ``v`` from the left.  With labels
numbered in preorder of the tree "left part of", latest built child first, that
is one interval of labels: a state is a list of intervals, inherited by states
that are split from it.

Every beginning of an accepted sequence is accepted, so a word is read byte by
byte: the last label at each place is the one, of those that end there, that the
state at its own beginning has an arc for.  Which labels end at a place comes
from a table of the labels' common endings.  All words of a batch take a step at
a time.  Decoding puts out the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsight.llm.text import pieces


def byte_of_sign() -> dict[str, int]:
    """How vocabularies of this kind spell bytes: visible Latin-1 signs stand for
    themselves, the other bytes, in order, for the signs from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + n): b for n, b in enumerate(hidden)}


def read_model(content: bytes) -> tuple[list[bytes], list[tuple[int, int]], list[int], dict[str, int]]:
    """Labels, rules (as numbers of labels), ids of labels, and added tokens of a model file.

    The first 256 labels are the bytes, each further one is made by one rule out
    of earlier ones.  A file that asks for more than byte-level BPE is refused.
    """
    model = json.loads(content)
    bpe, added = model["model"], model["added_tokens"]
    plain = (
        bpe["type"] == "BPE"
        and model["normalizer"] is None
        and model["pre_tokenizer"]["type"] == "ByteLevel"
        and not model["pre_tokenizer"]["add_prefix_space"]
        and not any(bpe.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
        and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not plain:
        raise ValueError("only plain byte-level BPE models are read")
    value, ids = byte_of_sign(), {}
    names = dict(zip(value.values(), value))
    labels = [bytes([b]) for b in range(256)]
    number = {label: n for n, label in enumerate(labels)}
    ids = [bpe["vocab"][names[b]] for b in range(256)]
    rules = []
    for rule in bpe["merges"]:
        left, right = rule if isinstance(rule, list) else rule.split(" ")
        u, v = (number.get(bytes(value[s] for s in part)) for part in (left, right))
        if u is None or v is None or labels[u] + labels[v] in number:
            raise ValueError(f"rule {rule} has parts that are not made before it, or makes a token again")
        number[labels[u] + labels[v]] = len(labels)
        labels.append(labels[u] + labels[v])
        rules.append((u, v))
        ids.append(bpe["vocab"][left + right])
    return labels, rules, ids, {t["content"]: t["id"] for t in added}


class Automaton:
    """Transition tables, and the walk along them."""

    _ARRAYS = (
        "ids", "length", "place", "state", "shorter", "lows", "highs", "edge", "child", "fail", "longest", "text", "bound",
    )

    #: Longer words are walked one by one; both ways give the same.
    LONG = 256

    @classmethod
    def compile(cls, labels: Sequence[bytes], rules: Sequence[tuple[int, int]], ids: Sequence[int]) -> Automaton:
        new = cls()
        size = len(labels)
        first = size - len(rules)
        # preorder of the tree of left parts, latest child first
        weight, used, offset, span = [1] * size, [1] * size, [0] * size, [0] * size
        for label in range(size - 1, first - 1, -1):
            u, v = rules[label - first]
            offset[label] = used[u]
            used[u] += weight[label]
            weight[u] += weight[label]
            # v and all that is built on it from this rule on
            span[label] = used[v]
        place, top = [0] * size, 0
        for label in range(size):
            if label < first:
                place[label], top = top, top + weight[label]
            else:
                place[label] = place[rules[label - first][0]] + offset[label]

        # gadgets in order; a state is the last interval taken from it, and its state before
        taken: list[tuple[int, int, int]] = []
        state = [-1] * size
        lacking: list[list[tuple[int, int]] | None] = []
        alive = [True] * size
        for label in range(first, size):
            u, v = rules[label - first]
            at, low = state[u], place[v]
            while at >= 0 and not taken[at][0] <= low < taken[at][1]:
                at = taken[at][2]
            if at >= 0 or not (alive[u] and alive[v]):
                alive[label] = False  # u is never followed by v: the rule has nothing to do
                continue
            state[label] = state[v]
            taken.append((low, low + span[label], state[u]))
            state[u] = len(taken) - 1

        # states in use, each with its intervals in order and joined
        number = {s: n for n, s in enumerate(sorted({s for s, a in zip(state, alive) if a}))}
        lows, highs = [], []
        for s, n in number.items():
            held = []
            while s >= 0:
                held.append(taken[s][:2])
                s = taken[s][2]
            held.sort()
            upto = -1
            for low, high in held:
                if low > upto:
                    lows.append(n * size + low)
                    highs.append(n * size + high)
                    upto = high
                elif high > upto:
                    highs[-1] = n * size + high
                    upto = high
        new.ids = np.array(ids, np.int32)
        new.length = np.array([len(x) for x in labels], np.int32)
        new.place = np.array(place, np.int32)
        # one more state, of a word's beginning, which lacks nothing
        new.state = np.array([number.get(s, 0) for s in state] + [len(number)], np.int32)
        new.lows, new.highs = np.array(lows, np.int64), np.array(highs, np.int64)
        new.bound = np.concatenate([[0], np.cumsum(new.length)]).astype(np.int32)
        new.text = np.frombuffer(b"".join(labels), np.uint8)
        new._endings(labels, alive)
        return new

    def _endings(self, labels: Sequence[bytes], alive: Sequence[bool]) -> None:
        """Trie of the labels with, for each node, the longest label that it ends in."""
        children: list[dict[int, int]] = [{}]
        node_of = {}
        for n, label in enumerate(labels):
            if alive[n]:
                node = 0
                for byte in label:
                    if byte not in children[node]:
                        children[node][byte] = len(children)
                        children.append({})
                    node = children[node][byte]
                node_of[node] = n
        fail, longest = [0] * len(children), [-1] * len(children)
        order = [0]
        for node in order:
            longest[node] = node_of.get(node, longest[fail[node]] if node else -1)
            for byte, child in children[node].items():
                order.append(child)
                back = fail[node]
                while node and byte not in children[back] and back:
                    back = fail[back]
                fail[child] = children[back].get(byte, 0) if node else 0
        shorter = [-1] * len(labels)
        for node, n in node_of.items():
            shorter[n] = longest[fail[node]]
        edges = sorted((node << 8 | byte, child) for node, held in enumerate(children) for byte, child in held.items())
        self.edge = np.array([e for e, _ in edges], np.int64)
        self.child = np.array([c for _, c in edges], np.int32)
        self.fail, self.longest = np.array(fail, np.int32), np.array(longest, np.int32)
        self.shorter = np.array(shorter, np.int32)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, **{name: getattr(self, name) for name in self._ARRAYS})
        return out.getvalue()

    @classmethod
    def load(cls, content: bytes) -> Automaton:
        new = cls()
        with np.load(io.BytesIO(content)) as held:
            for name in cls._ARRAYS:
                setattr(new, name, held[name])
        return new

    def _ends_in(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Next nodes of the trie; the root has a child for every byte."""
        node = node.copy()
        out = np.empty(len(node), np.int32)
        open_ = np.arange(len(node))
        while len(open_):
            key = node[open_].astype(np.int64) << 8 | byte[open_]
            at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            found = self.edge[at] == key
            out[open_[found]] = self.child[at[found]]
            open_ = open_[~found]
            node[open_] = self.fail[node[open_]]
        return out

    def _has_arc(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        key = state.astype(np.int64) * len(self.ids) + self.place[label]
        at = np.searchsorted(self.lows, key, side="right") - 1
        return (at < 0) | (self.highs[at] <= key)

    def encode(self, words: Sequence[bytes]) -> list[np.ndarray]:
        """Ids of every word."""
        out: list = [None] * len(words)
        short = []
        for n, word in enumerate(words):
            if len(word) > self.LONG:
                out[n] = self.ids[self._walk(word)]
            else:
                short.append(n)
        flat, bounds = self._walk_all([words[n] for n in short])
        flat = self.ids[flat]
        for n, begin, end in zip(short, bounds.tolist(), bounds[1:].tolist()):
            out[n] = flat[begin:end]
        return out

    def _walk_all(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Labels of all words in a row, and their bounds; one byte of every word at a time."""
        given = np.array([len(w) for w in words], np.int64)
        order = np.argsort(-given, kind="stable")
        held = given[order]
        data = np.frombuffer(b"".join([words[n] for n in order.tolist()]), np.uint8)
        begin = np.concatenate([[0], np.cumsum(held)])[:-1]
        # one place before each word, where its walk begins
        base = begin + np.arange(len(words))
        last = np.full(len(data) + len(words), -1, np.int32)
        node = np.zeros(len(words), np.int32)
        for step in range(int(held[0]) if len(held) else 0):
            active = int(np.searchsorted(-held, -step, side="left"))
            node[:active] = self._ends_in(node[:active], data[begin[:active] + step])
            label = self.longest[node[:active]]
            at = base[:active] + step + 1
            open_ = np.arange(active)
            while len(open_):
                offered = label[open_]
                before = last[at[open_] - self.length[offered]]
                good = self._has_arc(self.state[before], offered)
                done = open_[good]
                last[at[done]] = label[done]
                open_ = open_[~good]
                label[open_] = self.shorter[label[open_]]
        # back along the labels from the end of each word
        used = np.zeros(len(last), bool)
        at = base + held
        while len(at := at[last[at] >= 0]):
            used[at] = True
            at = at - self.length[last[at]]
        chosen = np.flatnonzero(used)
        low, high = np.searchsorted(chosen, base), np.searchsorted(chosen, base + held, side="right")
        # in the order the words were given
        low_of, size_of = np.empty_like(low), np.empty_like(low)
        low_of[order], size_of[order] = low, high - low
        bounds = np.concatenate([[0], np.cumsum(size_of)])
        take = np.arange(bounds[-1]) + np.repeat(low_of - bounds[:-1], size_of)
        return last[chosen[take]], bounds

    def _walk(self, word: bytes) -> list[int]:
        """Labels of one long word, in time that grows with its length."""
        if not hasattr(self, "_tables"):
            edges = dict(zip(self.edge.tolist(), self.child.tolist()))
            arrays = (self.fail, self.longest, self.shorter, self.length, self.place, self.state, self.lows, self.highs)
            self._tables = (edges, *[a.tolist() for a in arrays])
        edges, fail, longest, shorter, length, place, state, lows, highs = self._tables
        size, node, last = len(place), 0, [-1]
        for at, byte in enumerate(word, 1):
            while (child := edges.get(node << 8 | byte)) is None:
                node = fail[node]
            node = child
            label = longest[node]
            while True:
                key = state[last[at - length[label]]] * size + place[label]
                held = bisect_right(lows, key) - 1
                if held < 0 or highs[held] <= key:
                    break
                label = shorter[label]
            last.append(label)
        found, at = [], len(word)
        while at:
            found.append(last[at])
            at -= length[last[at]]
        return found[::-1]


class WordEncoder:
    """Encodes and decodes texts; ids of words are kept within a byte bound."""

    #: Bytes of distinct words walked together, and kept for later texts.
    BATCH_BYTES = 2 << 20
    KEPT_BYTES = 16 << 20

    def __init__(self, automaton: Automaton, pattern: str, added: dict[str, int]):
        import regex

        self.automaton = automaton
        self.split = regex.compile(pattern).findall
        named = "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))
        self.cut = re.compile(f"({named})").split if named else None
        self.added = {t: str(i) for t, i in added.items()}
        self.joined: dict[str, str] = dict(self.added)
        self.held = 0
        text, bound = automaton.text.tobytes(), automaton.bound.tolist()
        self.label = {str(i): text[a:b] for i, a, b in zip(automaton.ids.tolist(), bound, bound[1:])}
        self.label |= {str(i): t.encode() for t, i in added.items()}

    def _words(self, text: str) -> list[str]:
        parts = self.cut(text) if self.cut else [text]
        if len(parts) == 1:
            return self.split(text)
        # every second part is an added token
        return [w for n, part in enumerate(parts) for w in ([part] if n % 2 else self.split(part))]

    def encode(self, texts: Sequence[str]) -> list[str]:
        """Decimal ids of every text, joined by commas."""
        out: list[str] = []
        waiting: list[list[str]] = []
        fresh: dict[str, None] = {}
        size = 0
        for text in texts:
            words = self._words(text)
            waiting.append(words)
            new = set(words).difference(self.joined).difference(fresh)
            fresh.update(dict.fromkeys(new))
            size += sum(map(len, new))
            if size > self.BATCH_BYTES:
                self._learn(fresh)
                out += [",".join(map(self.joined.__getitem__, w)) for w in waiting]
                self._forget()
                waiting, fresh, size = [], {}, 0
        self._learn(fresh)
        out += [",".join(map(self.joined.__getitem__, w)) for w in waiting]
        self._forget()
        return out

    def _learn(self, fresh: dict[str, None]) -> None:
        names = list(fresh)
        for name, ids in zip(names, self.automaton.encode([n.encode() for n in names])):
            self.joined[name] = ",".join(map(str, ids.tolist()))
        self.held += sum(map(len, names))

    def _forget(self) -> None:
        if self.held > self.KEPT_BYTES:
            self.joined, self.held = dict(self.added), 0

    def decode(self, joined: str) -> str:
        """Text of joined ids; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.label.__getitem__, joined.split(","))).decode("utf-8", "replace") if joined else ""


_LOADED: dict[int, tuple] = {}


def _loaded(shared) -> tuple[Automaton, dict[str, int]]:
    """Unpacked once per worker process, which serves many tasks."""
    content, added = shared.value
    key = hash(content)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = (Automaton.load(content), added)
    return _LOADED[key]


def _shared(df: DataFrame, model: bytes):
    """Compiled on the driver; the tables grow with the vocabulary only."""
    labels, rules, ids, added = read_model(model)
    return df.sparkSession.sparkContext.broadcast((Automaton.compile(labels, rules, ids).dump(), added))


def tokenize_documents(docs: DataFrame, model: bytes, pattern: str, ids: bool = True) -> DataFrame:
    """Per row: doc_id, n_tokens, digests of ids and of the decoded text, and the ids.

    ``model`` is the content of a byte-level BPE file with its merges,
    ``pattern`` what splits texts into words.  Added tokens of the file are
    found in texts first.  NULL and empty texts have no ids; repeated rows each
    give a row; other columns are left out.  No shuffle.
    """
    shared = _shared(docs, model)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(_loaded(shared)[0], pattern, _loaded(shared)[1])
        sha = hashlib.sha256
        for batch in batches:
            for piece in pieces(batch, "text"):
                joined = encoder.encode([t or "" for t in piece.column("text").to_pylist()])
                columns = [
                    piece.column("doc_id"),
                    pa.array([j.count(",") + 1 if j else 0 for j in joined], pa.int64()),
                    pa.array([sha(j.encode()).hexdigest() for j in joined], pa.string()),
                    pa.array([sha(encoder.decode(j).encode()).hexdigest() for j in joined], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    columns.append(pa.array([[int(i) for i in j.split(",")] if j else [] for j in joined], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(build, schema + (", ids array<int>" if ids else ""))


def detokenize(encoded: DataFrame, model: bytes, pattern: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Add the text of an array of ids (NULL: NULL), replacing a column of that name."""
    shared = _shared(encoded, model)
    kept = encoded.select(*[F.col(f"`{c}`") for c in encoded.columns if c != out])
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(_loaded(shared)[0], pattern, _loaded(shared)[1])
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = [None if i is None else encoder.decode(",".join(map(str, i))) for i in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return kept.mapInArrow(build, schema)
