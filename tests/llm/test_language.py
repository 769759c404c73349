import itertools
import random

import numpy as np
import pytest
from llm_rows import by_id
from pyspark.sql import functions as F

from subsight.llm.language import CrfRule, document_languages, fit, fit_on, keep_identified, label_documents, posteriors

SYLLABLES = {"aa": "ba be bi bo".split(), "bb": "zat zut zot zit".split(), "cc": "ñu ñe ñi ña".split()}
RULE = CrfRule(per_label=40, epochs=3, words_per_batch=400, dimensions=1 << 12)


def text_of(draw, label, words=40):
    return " ".join("".join(draw.choices(SYLLABLES[label], k=draw.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(6)
    rows = [(i, text_of(draw, label := draw.choice(list(SYLLABLES))), label, "s", 1) for i in range(240)]
    rows += [(900, None, "aa", None, 1), (901, "", None, None, 1), (902, "123 !!! _", "bb", None, 1), (903, "x", None, None, 1)]
    rows.append((904, text_of(draw, "bb", 30_000), None, None, 1))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_posteriors_match_enumeration():
    draw = np.random.Generator(np.random.PCG64(2))
    move, start = draw.normal(size=(3, 3)).astype(np.float32), draw.normal(size=3).astype(np.float32)
    lengths = np.array([1, 4, 2, 4])
    emission = draw.normal(size=(lengths.sum(), 3)).astype(np.float32)
    got, counts = posteriors(emission, lengths, move, start, pairs=True)
    pairs, at = np.zeros((3, 3)), 0
    for n in lengths:
        own, total = np.zeros((n, 3)), 0.0
        inner = np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            score = start[path[0]] + sum(emission[at + i, y] for i, y in enumerate(path))
            weight = np.exp(score + sum(move[a, b] for a, b in zip(path, path[1:])))
            total += weight
            for i, y in enumerate(path):
                own[i, y] += weight
            for a, b in zip(path, path[1:]):
                inner[a, b] += weight
        np.testing.assert_allclose(got[at : at + n], own / total, atol=1e-5)
        pairs += inner / total
        at += n
    np.testing.assert_allclose(counts, pairs, atol=1e-4)


def test_held_out_accuracy_and_edge_cases(corpus):
    found = by_id(document_languages(corpus, RULE))
    labels = {r.doc_id: r.lang for r in corpus.collect()}
    real = [i for i in range(240) if found[i].held_out]
    assert len(real) > 30 and np.mean([found[i].lang_pred == labels[i] for i in real]) > 0.97
    for i in (900, 901, 902):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert found[904].lang_pred == "bb" and 0.9 < found[904].score <= 1
    assert found[903].lang_pred in SYLLABLES


def test_switching_text_is_cut_where_it_switches(spark, corpus):
    draw = random.Random(1)
    mixed = text_of(draw, "aa", 12) + " " + text_of(draw, "cc", 15) + " " + text_of(draw, "bb", 9)
    docs = spark.createDataFrame([(1, mixed, "z")], "doc_id bigint, text string, segments string")
    row = label_documents(docs, fit_on(corpus, RULE)).first()
    assert [(s.lang, s.words) for s in row.segments] == [("aa", 12), ("cc", 15), ("bb", 9)]


def test_filter_keeps_rows_and_columns(corpus):
    kept = keep_identified(corpus, fit_on(corpus, RULE))
    assert kept.columns == corpus.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == set(range(240)) | {903, 904}


def test_without_labels_nothing_is_determined(documents):
    docs = documents(["a b", "c"]).drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {r.lang_pred for r in document_languages(docs).collect()} == {"und"}
    assert document_languages(documents([])).count() == 0
    assert fit([("only", "one label")]).labels == ["only"]


def test_signs_that_are_no_letters(spark, corpus):
    rows = [(1, "² ½ ① Ⅳ"), (2, "½bazat"), (3, "٣")]
    found = by_id(label_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), fit_on(corpus, RULE)))
    assert found[1].lang_pred == found[3].lang_pred == "und" and found[2].lang_pred != "und"


def test_many_labels_long_texts_and_clashing_names(spark):
    draw = random.Random(1)
    rows = [(i, text_of(draw, "aa"), "aa") for i in range(60)] + [(100 + i, text_of(draw, "bb", 400), "bb") for i in range(40)]
    rows += [(200 + i, text_of(draw, "cc"), f"l{i:02d}") for i in range(90)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    for name in ("_id", "id", "label", "draw", "place", "long"):
        table = table.withColumn(name, F.lit(5))
    rule = CrfRule(per_label=20, max_labels=3, max_chars=500, epochs=1, words_per_batch=400, dimensions=1 << 12)
    model = fit_on(table, rule)
    # the two largest, and the first of those with one row that is not held out
    assert model.labels[:2] == ["aa", "bb"] and len(model.labels) == 3
    assert by_id(document_languages(table, rule)).keys() == {r[0] for r in rows}


def test_nothing_labelled_keeps_all(spark):
    table = spark.createDataFrame([(1, "x", None), (2, None, None)], "doc_id bigint, text string, lang string")
    assert keep_identified(table, fit_on(table, RULE)).count() == 2
