"""The registered queries of the package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    langid,
    negatives,
    oracles,
    packing,
    personal,
    pieces,
    quality,
    search,
    simhash,
    tokencount,
    toxicity,
    urls,
    warc,
)
from tidemark.llm.common import fold


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = fold(5) == 0
    machine = toxicity.train(docs, _table(spark, folder, "labels").where(~held_out))
    return toxicity.judge(docs.withColumn("held_out", held_out), machine, ["doc_id", "held_out"])


#: The rules of the url query: verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(_table(spark, folder, "pages"), URL_RULES)


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.leaks(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark"), window=10
    )
    items = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.personal_data(_table(spark, folder, "documents"))
    counts = [personal.count_kind(F.col("base"), k).alias(f"n_{k}") for k in personal.KINDS]
    digest = F.sha2(personal.span_list(F.col("base")).cast("binary"), 256)
    return found.select(
        "doc_id",
        *counts,
        digest.alias("base_sha256"),
        personal.span_list(F.col("spans")).alias("spans"),
    )


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(_table(spark, folder, "documents"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return tokencount.count_tokens(_table(spark, folder, "documents"), model, limit=4096)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.capture_history(_table(spark, folder, "pages"), min_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(_table(spark, folder, "documents"), model, end_id=2, length=4096)
    return packing.with_digest(pieces)


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = fold(3) == 1
    net = langid.train(docs.where(~held_out))
    marked = docs.withColumn("held_out", held_out)
    return langid.predict(marked, net, keep=["doc_id", "held_out"])


def op10_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_copies(_table(spark, folder, "documents"), shingle_words=3, max_bits=2)
    return found.select(
        "doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("bigint")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(_table(spark, folder, "embeddings"), vec_id % 100 == 0, moved)


def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.with_digests(pieces.encode(_table(spark, folder, "documents"), model), model)


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), top=10)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_toxicity,
        op2_url_filters,
        op3_benchmark_decontamination,
        op4_personal_data,
        op5_quality_rules,
        op6_token_counts,
        op7_warc,
        op8_packing,
        op9_language_id,
        op10_simhash_near_dedup,
        op11_hard_negatives,
        op12_sentencepiece,
        op13_ranked_search,
        pipeline,
    ]
    return {f.__name__: f for f in found}


def llm_oracles() -> dict[str, str]:
    return {
        "op2_url_filters": oracles.url_rules(URL_RULES),
        "op3_benchmark_decontamination": oracles.LEAKS,
        "op5_quality_rules": oracles.quality_rules(
            quality.COMMON_WORDS,
            {"char": quality.MIN_CHARS, "word": quality.MIN_WORDS},
            quality.SPREADS,
            quality.LEAST_SPREADS,
            quality.MIN_JUDGED,
            quality.MIN_REFERENCE,
        ),
        "op7_warc": oracles.CAPTURES,
        "op11_hard_negatives": oracles.HARD_NEGATIVES,
        "op13_ranked_search": oracles.RANKED,
    }
