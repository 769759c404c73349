"""Training corpus from documents: five stages, each on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subsight.llm.bpe import encode_documents
from subsight.llm.decontaminate import drop_leaks
from subsight.llm.language import fit_on, keep_identified
from subsight.llm.near_dup import NearDup, drop_near_duplicates
from subsight.llm.queries import table, tokenizer
from subsight.llm.secrets import redact
from subsight.llm.storage import release, remove_folder
from subsight.session import shared_folder


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determined language go."""
    return keep_identified(docs, fit_on(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, at 85 of 100 shingles, stays."""
    return drop_near_duplicates(docs, rule=NearDup(percent=85))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; the documents stay."""
    cleaned = redact(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with digests of the ids and of what they decode to."""
    ranks, pattern = tokenizer()
    return encode_documents(docs, ranks, pattern)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]

#: The language model has no SQL form; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again.

    Once a stage's result is stored, the table it read and what it shuffled are
    of no use any more: the table is removed, and the driver's JVM is asked to
    collect, which makes Spark drop the shuffles of plans that are gone.
    """
    docs = table(spark, sf_dir, "documents")
    root = f"{shared_folder(spark).rstrip('/')}/pipeline-{_run_id(spark)}"
    earlier = None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if earlier is not None:
            remove_folder(spark, earlier)
        earlier = path
        release(spark)
    return docs


def _run_id(spark: SparkSession) -> str:
    return spark.sql("SELECT replace(uuid(), '-', '')").first()[0]
