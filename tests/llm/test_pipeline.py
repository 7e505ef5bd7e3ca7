import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontaminate import brute as brute_leaks
from tests.llm.test_simhash import brute_components, brute_print
from tidemark.llm import langid, personal
from tidemark.llm.common import fold

SAMPLE = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    net = langid.train(docs.where(fold(3) != 1))
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}

    def known(text):
        found = langid.document_probabilities(net, [text.encode()])[0]
        return bool(langid.LETTER.search(text)) and found.max() >= corpus_pipeline.MIN_LANGUAGE_SCORE

    rows = {i: t for i, t in rows.items() if known(t)}
    ids = sorted(rows)
    lead = brute_components([brute_print(rows[i]) for i in ids], ids)
    rows = {i: rows[i] for i, c in zip(ids, lead, strict=True) if c == i}
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SAMPLE}/benchmark.parquet").collect()]
    rows = {i: t for i, t in rows.items() if not brute_leaks(t, items, 10)[1]}
    assert 0 < len(rows) < len(ids)

    stages = dict(corpus_pipeline.STAGES)
    step = docs
    for name in ("language_id", "simhash_near_dedup", "benchmark_decontamination"):
        step = stages[name](spark, step, SAMPLE)
        assert step.columns == docs.columns
    assert {r["doc_id"]: r["text"] or "" for r in step.collect()} == rows

    masked = {r["doc_id"]: r["text"] for r in stages["personal_data"](spark, step, SAMPLE).collect()}
    for i, text in rows.items():
        spans = personal.base_spans(text, list(personal._REGION.finditer(text)))
        assert masked[i].count("<") - text.count("<") >= 0 and (masked[i] != text or not spans)
        assert personal.base_spans(masked[i], list(personal._REGION.finditer(masked[i]))) == []

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    final = corpus_pipeline.run(spark, SAMPLE).collect()
    assert {r["doc_id"] for r in final} == set(rows)
    for r in final:
        own = tokenizer.encode(masked[r["doc_id"]], add_special_tokens=False).ids + [2]
        part = np.array(own[r["start"] : r["start"] + r["length"]], "<u4")
        assert (r["doc_tokens"], r["ids_crc32"]) == (len(own), zlib.crc32(part.tobytes()))


def test_every_stage_takes_odd_rows(spark, odd_docs, make_docs):
    for docs in (odd_docs, make_docs([])):
        step = docs
        for name, stage in corpus_pipeline.STAGES:
            step = stage(spark, step, SAMPLE)
            if name != "packing":
                assert step.columns == docs.columns
        step.collect()
