import random

import pytest

import __spark_entry__
import corpus_pipeline
from subsight.llm.language import fit_on, label_documents
from subsight.llm.secrets import Scanner

DRAW = random.Random(17)
SYLLABLES = {"aa": "ba be bi bo".split(), "bb": "zat zut zot zit".split()}


def prose(label, words):
    return " ".join("".join(DRAW.choices(SYLLABLES[label], k=DRAW.randint(2, 5))) for _ in range(words))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    item = prose("aa", 20)
    rows = [(i, prose(lang := DRAW.choice(["aa", "bb"]), 60), lang, "s") for i in range(80)]
    rows += [(100, rows[3][1], "aa", "s"), (101, prose("aa", 30) + " " + item, "aa", "s"), (102, "12 !", "aa", "s")]
    rows += [(103, prose("bb", 40) + " password=hunter2hunter2", "bb", None), (104, None, None, None), (105, "", "aa", "s")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(str(root / "benchmark.parquet"))
    return str(root)


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = {r.doc_id: r for r in docs.collect()}
    assert set(kept["language_id"]) == set(range(80)) | {100, 101, 103}
    assert set(kept["near_dedup"]) == set(kept["language_id"]) - {100}
    assert set(kept["decontamination"]) == set(kept["near_dedup"]) - {101}
    last = kept["secret_scan"]
    assert set(last) == set(kept["decontamination"])
    assert "hunter2" not in last[103].text and last[103].n_chars == len(last[103].text)
    assert not any(Scanner().spans(r.text) for r in last.values())
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in encoded.collect()} == set(last)


def test_run_is_the_stages_in_a_row(spark, folder):
    found = corpus_pipeline.run(spark, folder).collect()
    assert len(found) == 81 and all(len(r.ids) == r.n_tokens for r in found)


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {f"{n.split('_')[0]}_" for n in names if n.startswith("op")}
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= names


def test_language_filter_agrees_with_labels(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = fit_on(docs)
    shares = {r.doc_id: r.score for r in label_documents(docs, model).collect()}
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, folder).collect()}
    assert kept == {i for i, s in shares.items() if s >= 0.3}
