"""Language identification with a linear-chain conditional random field.

Every word is a position, every language a state.  Emission features of a
word are its character n-grams with marks for begin and end (so they include
prefixes and suffixes) and its membership in the lexicon of each language.
Transitions between the languages of neighbouring words are learned from
sequences that switch between texts of different languages.  A document's
words get posterior probabilities by forward-backward; their mean, weighted by
letters, is the document's share of each language.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsight.llm.text import mix, pieces

_WORD = regex.compile(r"\p{L}+")
_U = np.uint64
UNDETERMINED = "und"


@dataclass(frozen=True)
class CrfRule:
    """Bounds of the training sample and settings of the fit.

    ``per_label`` rows of each label, the ones with the smallest hash of their
    id, are brought to the driver: texts of ``max_chars`` characters at most
    first, then that many characters of longer ones.  Of more than
    ``max_labels`` labels those with the most rows are learned, in the order of
    labels on ties; the others are never predicted.
    """

    per_label: int = 150
    max_chars: int = 20_000
    max_labels: int = 64
    dimensions: int = 1 << 17
    ngrams: tuple[int, ...] = (2, 3, 4)
    lexicon_documents: int = 2
    epochs: int = 4
    words_per_batch: int = 16_000
    words_per_sequence: int = 64
    rate: float = 0.05
    decay: float = 1e-4
    seed: int = 5


def word_list(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class CrfModel:
    """Weights of the features and of the transitions."""

    def __init__(self, labels: list[str], lexicon: dict[str, np.ndarray], rule: CrfRule):
        k = len(labels)
        self.labels, self.lexicon, self.rule = labels, lexicon, rule
        self.ngram = np.zeros((rule.dimensions, k), np.float32)
        self.lexical = np.zeros((k, k), np.float32)
        self.transition = np.zeros((k, k), np.float32)
        self.start = np.zeros(k, np.float32)

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashed n-grams of all words in a row, the word of each, and lexicon bits."""
        marked = "".join(["\x02" + w + "\x03" for w in words])
        points = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        ends = np.flatnonzero(points == 3)
        word_of = np.searchsorted(ends, np.arange(len(points)))
        features, owners = [], []
        with np.errstate(over="ignore"):
            for n in self.rule.ngrams:
                if len(points) < n:
                    continue
                value = np.full(len(points) - n + 1, n, np.uint64)
                for j in range(n):
                    value = value * _U(1000003) + points[j : j + len(value)]
                inside = word_of[: len(value)] == word_of[n - 1 :]
                features.append((mix(value[inside]) % _U(self.rule.dimensions)).astype(np.int64))
                owners.append(word_of[: len(value)][inside])
        none = np.zeros(len(self.labels), np.float32)
        bits = np.array([self.lexicon.get(w, none) for w in words], np.float32).reshape(len(words), len(self.labels))
        if not features:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), bits
        return np.concatenate(features), np.concatenate(owners), bits

    def emissions(self, words: list[str]) -> np.ndarray:
        """Score of every word for every label."""
        grams, owner, bits = self.features(words)
        out = bits @ self.lexical
        for label in range(len(self.labels)):
            out[:, label] += np.bincount(owner, self.ngram[grams, label], minlength=len(words))
        return out


def _steps(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Time-major places for sequences stored one after another.

    Longest first, so the sequences alive at step t are the first ones.
    Returns the place of each element, the bounds of the steps and the order.
    """
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    longest = int(lengths.max(initial=0))
    alive = np.cumsum(np.bincount(lengths, minlength=longest + 1)[::-1])[::-1][1:]
    bounds = np.concatenate([[0], np.cumsum(alive)])
    step = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return bounds[step] + np.repeat(rank, lengths), bounds, order


def posteriors(
    emission: np.ndarray, lengths: np.ndarray, transition: np.ndarray, start: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """Forward-backward over many sequences, one step of all at a time.

    ``emission`` holds the sequences one after another.  Returns the posterior
    of each element, and expected transition counts if asked for.
    """
    place, bounds, _ = _steps(lengths)
    factor = np.exp(emission - emission.max(axis=1, keepdims=True)).astype(np.float32)
    timed = np.empty_like(factor)
    timed[place] = factor
    move = np.exp(transition - transition.max()).astype(np.float32)
    ahead = np.empty_like(timed)
    edges = bounds.tolist()
    for t, (lo, hi) in enumerate(zip(edges, edges[1:])):
        now = ahead[lo:hi]
        if t:
            before = edges[t - 1]
            np.matmul(ahead[before : before + hi - lo], move, out=now)
            now *= timed[lo:hi]
        else:
            np.multiply(timed[lo:hi], np.exp(start - start.max()), out=now)
        now /= now.sum(axis=1, keepdims=True)
    behind = np.ones_like(timed)
    counts = np.zeros_like(move) if pairs else None
    back = np.ascontiguousarray(move.T)
    for t in range(len(edges) - 3, -1, -1):
        lo, mid, hi = edges[t], edges[t + 1], edges[t + 2]
        later = timed[mid:hi] * behind[mid:hi]
        now = behind[lo : lo + hi - mid]
        np.matmul(later, back, out=now)
        if pairs:
            ahead_now = ahead[lo : lo + hi - mid]
            norm = (ahead_now * now).sum(axis=1, keepdims=True)
            counts += move * ((ahead_now / norm).T @ later)
        now /= now.sum(axis=1, keepdims=True)
    ahead *= behind
    ahead /= ahead.sum(axis=1, keepdims=True)
    return ahead[place], counts


def labelled_sample(docs: DataFrame, id_column: str, text: str, label: str, rule: CrfRule) -> list[tuple[str, str]]:
    """(label, text) of a bounded, repeatable sample; see :class:`CrfRule`."""
    length = F.length(F.col(f"`{text}`"))
    usable = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.col(f"`{label}`").cast("string").alias("label"),
        F.substring(F.col(f"`{text}`").cast("string"), 1, rule.max_chars).alias("text"),
        (length > rule.max_chars).alias("long"),
    ).where("label IS NOT NULL AND length(text) > 0")
    keys = usable.select("label", "id", "long", F.xxhash64("id").alias("draw"))
    ranked = Window.partitionBy("label").orderBy("long", "draw", "id")
    most = rule.per_label * rule.max_labels

    def drawn(of: DataFrame) -> list:
        chosen = of.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= rule.per_label)
        return chosen.select("id", "label").limit(most + 1).collect()

    rows = drawn(keys)
    if len({r.label for r in rows}) > rule.max_labels or len(rows) > most:
        counts = keys.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label")
        rows = drawn(keys.where(F.col("label").isin([r.label for r in counts.limit(rule.max_labels).collect()])))
    wanted = docs.sparkSession.createDataFrame(sorted({(r.id, r.label) for r in rows}, key=str), "id bigint, label string")
    # bounded by per_label * max_labels ids
    held = usable.join(F.broadcast(wanted), ["id", "label"]).select("id", "label", "text")
    found = {(r[0], r[1], r[2]) for r in held.collect()}
    return [(r[1], r[2]) for r in sorted(found)]


def fit(sample: list[tuple[str, str]], rule: CrfRule = CrfRule()) -> CrfModel:
    """Maximum conditional likelihood by Adam over shuffled switching sequences."""
    labels = sorted({label for label, _ in sample})
    number = {label: i for i, label in enumerate(labels)}
    texts = [(number[label], words) for label, text in sample if (words := word_list(text))]
    seen: dict[str, Counter] = defaultdict(Counter)
    for label, words in texts:
        for word in set(words):
            seen[word][label] += 1
    lexicon = {}
    for word, by in seen.items():
        bits = np.array([by[i] >= rule.lexicon_documents for i in range(len(labels))], np.float32)
        if bits.any():
            lexicon[word] = bits
    model = CrfModel(labels, lexicon, rule)
    if len(labels) < 2 or not texts:
        return model

    names = list(seen)
    index = {w: i for i, w in enumerate(names)}
    draw = np.random.Generator(np.random.PCG64(rule.seed))
    k = len(labels)
    params = [model.ngram, model.lexical, model.transition, model.start]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    updates = 0
    for _ in range(rule.epochs):
        for chunk, gold, lengths in _batches(texts, index, draw, rule):
            local, position = np.unique(chunk, return_inverse=True)
            grams, owner, bits = model.features([names[i] for i in local])
            scores = bits @ model.lexical
            for label in range(k):
                scores[:, label] += np.bincount(owner, model.ngram[grams, label], minlength=len(local))
            post, counts = posteriors(scores[position], lengths, model.transition, model.start, pairs=True)
            error = post
            error[np.arange(len(gold)), gold] -= 1.0
            per_word = np.stack([np.bincount(position, error[:, i], minlength=len(local)) for i in range(k)], axis=1)
            scale = 1.0 / len(lengths)
            heads = np.cumsum(lengths) - lengths
            inner = np.ones(len(gold), bool)
            inner[heads] = False
            true = np.zeros((k, k), np.float32)
            np.add.at(true, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
            ngram = np.stack(
                [np.bincount(grams, per_word[owner, i], minlength=rule.dimensions) for i in range(k)], axis=1
            )
            grads = [ngram, bits.T @ per_word, counts - true, error[heads].sum(axis=0)]
            updates += 1
            for p, g, (m, v) in zip(params, grads, moments):
                g = (g * scale).astype(np.float32) + rule.decay * p
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rule.rate * (m / (1 - 0.9**updates)) / (np.sqrt(v / (1 - 0.99**updates)) + 1e-6)
    return model


def _batches(texts, index, draw, rule: CrfRule) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sequences put together from stretches of different texts."""
    stretches = []
    for label, words in texts:
        ids = np.array([index[w] for w in words], np.int64)
        at = 0
        while at < len(ids):
            size = int(draw.integers(3, rule.words_per_sequence))
            stretches.append((label, ids[at : at + size]))
            at += size
    ids, gold, lengths, open_, total = [], [], [], 0, 0
    for i in draw.permutation(len(stretches)):
        label, part = stretches[i]
        ids.append(part)
        gold.append(np.full(len(part), label))
        open_, total = open_ + len(part), total + len(part)
        if open_ >= rule.words_per_sequence:
            lengths.append(open_)
            open_ = 0
            if total >= rule.words_per_batch:
                yield np.concatenate(ids), np.concatenate(gold), np.array(lengths)
                ids, gold, lengths, total = [], [], [], 0
    if open_:
        lengths.append(open_)
    if lengths:
        yield np.concatenate(ids), np.concatenate(gold), np.array(lengths)


class Tagger:
    """Applies a model; emissions of words are kept within a bound."""

    KEPT_WORDS = 150_000

    def __init__(self, model: CrfModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.labels)), np.float32)
        self.letters = np.zeros(0, np.float32)

    def tag(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Posteriors and letters of all words, and the number of words by text."""
        if len(self.index) > self.KEPT_WORDS:
            self._forget()
        index, ids, lengths = self.index, [], np.zeros(len(texts), np.int64)
        known = len(index)
        for i, text in enumerate(texts):
            own = word_list(text) if text else []
            lengths[i] = len(own)
            for word in set(own).difference(index):
                index[word] = len(index)
            ids.append(np.fromiter(map(index.__getitem__, own), np.int64, len(own)))
        fresh = list(index)[known:] if len(index) > known else []
        if fresh:
            self.scores = np.concatenate([self.scores, self.model.emissions(fresh).astype(np.float32)])
            self.letters = np.concatenate([self.letters, np.array([len(w) for w in fresh], np.float32)])
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        if not len(flat):
            return np.zeros((0, len(self.model.labels)), np.float32), np.zeros(0, np.float32), lengths
        found = lengths > 0
        post, _ = posteriors(self.scores[flat], lengths[found], self.model.transition, self.model.start)
        return post, self.letters[flat], lengths


def label_documents(
    docs: DataFrame,
    model: CrfModel,
    id_column: str = "doc_id",
    text: str = "text",
    segments: bool = True,
) -> DataFrame:
    """Per row: id, lang_pred, score, and the runs of words with one language.

    ``score`` is the share of ``lang_pred``, the language with the largest
    share; the first in the order of labels on ties.  NULL texts, texts without
    a letter and a model without labels give ``und`` and 0.  Repeated rows stay.
    No shuffle; the model is sent with the tasks and its size is fixed by
    its rule, not by the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    run_type = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        tagger, labels = Tagger(own), np.array([*own.labels, UNDETERMINED], object)
        for batch in batches:
            for piece in pieces(batch, text, 8 << 20):
                n = piece.num_rows
                best, score = np.full(n, len(own.labels)), np.zeros(n)
                runs = [[] for _ in range(n)]
                if own.labels:
                    post, letters, lengths = tagger.tag(piece.column(text).to_pylist())
                    full = np.flatnonzero(lengths)
                    if len(full):
                        heads = (np.cumsum(lengths) - lengths)[full]
                        share = np.add.reduceat(post * letters[:, None], heads, axis=0, dtype=np.float64)
                        share /= share.sum(axis=1, keepdims=True)
                        best[full] = share.argmax(axis=1)
                        score[full] = np.minimum(share.max(axis=1), 1.0)
                        if segments:
                            _runs(post.argmax(axis=1), heads, full, labels, runs)
                columns = [piece.column(id_column), pa.array(labels[best], pa.string()), pa.array(score)]
                names = [id_column, "lang_pred", "score"]
                if segments:
                    columns.append(pa.array(runs, run_type))
                    names.append("segments")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias(id_column), F.col(f"`{text}`").cast("string").alias(text))
    schema = f"`{id_column}` bigint, lang_pred string, score double"
    return rows.mapInArrow(build, schema + (", segments array<struct<lang:string,words:bigint>>" if segments else ""))


def _runs(path, heads, full, labels, out) -> None:
    fresh = np.ones(len(path), bool)
    fresh[1:] = path[1:] != path[:-1]
    fresh[heads] = True
    begin = np.flatnonzero(fresh)
    sizes = np.diff(np.append(begin, len(path)))
    owner = full[np.searchsorted(heads, begin, side="right") - 1]
    for doc, label, size in zip(owner.tolist(), labels[path[begin]].tolist(), sizes.tolist()):
        out[doc].append({"lang": label, "words": size})


def held_out(id_column: Column) -> Column:
    """Documents that no model may learn from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on(docs: DataFrame, rule: CrfRule = CrfRule()) -> CrfModel:
    """A model from the labelled documents that are not held out."""
    usable = docs.where(~held_out(F.col("doc_id")))
    return fit(labelled_sample(usable, "doc_id", "text", "lang", rule), rule)


def document_languages(docs: DataFrame, rule: CrfRule = CrfRule()) -> DataFrame:
    """Predicted language of every document, from a model fitted on the others."""
    found = label_documents(docs.select("doc_id", "text"), fit_on(docs, rule), segments=False)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: CrfModel, text: str = "text", least: float = 0.3) -> DataFrame:
    """The rows, with all columns, whose language is determined.

    Texts without a letter go, and those whose best language has a share under
    ``least``; mixed texts of known languages stay.  A model without labels
    keeps every row.
    """
    columns = docs.columns
    at = columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        tagger = Tagger(own)
        for batch in batches:
            for piece in pieces(batch, text):
                # without labels nothing can be told, and all rows stay
                best = np.full(piece.num_rows, 0.0 if own.labels else 1.0)
                if own.labels:
                    post, letters, lengths = tagger.tag(piece.column(at).to_pylist())
                    full = np.flatnonzero(lengths)
                    if len(full):
                        heads = (np.cumsum(lengths) - lengths)[full]
                        share = np.add.reduceat(post * letters[:, None], heads, axis=0, dtype=np.float64)
                        best[full] = share.max(axis=1) / share.sum(axis=1)
                yield piece.filter(pa.array(best >= least))

    return docs.mapInArrow(build, docs.schema)
