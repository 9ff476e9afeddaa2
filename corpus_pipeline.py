"""The corpus pipeline: from raw documents to token records.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All stages
but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from longitab.llm import jaccard, language, mixing, records, templates
from longitab.llm.common import BATCH_BYTES, small_batches
from longitab.llm.queries import vocabulary
from longitab.session import stage


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_python(size: int = BATCH_BYTES) -> Callable[[Stage], Stage]:
    """A stage that runs with batches of about ``size`` bytes; the session keeps the setting, as its result is computed later."""
    def small(apply: Stage) -> Stage:
        @wraps(apply)
        def run_small(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            small_batches(spark, size)
            return apply(spark, docs, sf_dir)

        return run_small

    return small


@_in_python(8 * BATCH_BYTES)  # a worker gives memory back after each batch, which takes time
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language.accepted(docs)


@_in_python()
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each group linked at 0.8 on five-word shingles."""
    return jaccard.one_per_group(docs, words=5, threshold="0.8")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; one of a word or two names nothing that must go."""
    return templates.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least_tokens=3)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks."""
    return mixing.mixed_documents(docs)


@_in_python()
def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records written, and per record what reading them back gives."""
    return records.tokenized(docs, vocabulary("word_bpe_49k.json")).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_records", token_records),
]

#: SQL has no tokenizer and no trained model: ``tests/llm`` holds a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
