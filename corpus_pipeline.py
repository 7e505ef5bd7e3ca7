"""The training corpus in five stages, each written as Parquet before the next reads it.

All stages take missing ids and texts, empty and very long texts, repeated rows, empty tables and further
columns of any names; all but the last return the columns they got.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, langid, packing, personal, simhash
from tidemark.llm.common import fold
from tidemark.storage import materialize

#: Mean probability that a document's language needs to stay.
MIN_LANGUAGE_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the network learns from two folds of three.

    Missing and empty texts, and those without a letter, have no language and go.
    """
    return langid.keep_known(docs, langid.train(docs.where(fold(3) != 1)), MIN_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, else the first in the files.

    Texts without words are copies of one another. Rows without an id stay where no id is reachable.
    """
    return simhash.drop_near_copies(docs, shingle_words=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; missing and empty texts stay."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; missing and empty texts as they are."""
    return personal.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens; a missing or empty text is its end id alone."""
    model = public_tokenizers.path("word_bpe_49k.json")
    return packing.with_digest(packing.pack(docs, model, end_id=2, length=4096))


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: The network, the fingerprints and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
