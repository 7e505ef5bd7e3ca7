import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.conftest import SAMPLES
from tidemark.llm import pieces
from tidemark.llm.queries import llm_queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = [*"ab e.T▁ \n\t  éß😀ñ\x00\x01<s>|1", " the", "<unk>", "<0x41>", "</s>", "　", "\r\n", " ﬁ", "①", "﻿"]


@pytest.fixture(scope="module")
def tool():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_chunks_and_decoder_equal_the_library(tool):
    rng, model, decoder = random.Random(1), pieces.Model(PATH), pieces.Decoder(PATH)
    for _ in range(20_000):
        text = "".join(rng.choices(ALPHABET, k=rng.randrange(14)))
        own = tool.encode(text)
        found = b"".join(model.segment(model.mark(text.encode())))
        assert np.frombuffer(found, model.code).tolist() == own
        odd = [rng.randrange(32_000) if rng.random() < 0.6 else rng.randrange(260) for _ in range(rng.randrange(8))]
        sizes = [len(own), len(odd)]
        assert decoder.texts(np.array(own + odd, np.int64), sizes) == [tool.decode(own), tool.decode(odd)]


def expected(tool, docs):
    out = []
    for r in docs.collect():
        ids = tool.encode(r["text"] or "")
        digests = [sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), tool.decode(ids))]
        out.append((r["doc_id"], len(ids), *digests))
    return sorted(out, key=str)


def test_query_equals_the_library(spark, tool):
    folder = f"{SAMPLES}/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = llm_queries()["op12_sentencepiece"](spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(tool, docs)


def test_small_slices(tool, monkeypatch, spark):
    from pyspark import TaskContext

    monkeypatch.setattr(pieces, "SLICE_CHUNKS", 30)
    monkeypatch.setattr(TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 3})())
    docs = spark.createDataFrame([(i, f"word{i} and word{i % 7}\nline {i}") for i in range(100)], "doc_id long, text string")
    seen = {}

    class Mapped(Exception):
        pass

    def hold(df, run, kind):
        seen["run"] = run
        raise Mapped

    monkeypatch.setattr(pieces, "map_batches", hold)
    with pytest.raises(Mapped):
        pieces.mark_rows(docs, PATH, 5)
    batches = [b for x in range(10) for b in docs.toArrow().slice(10 * x, 10).to_batches()]
    rows = [r for b in seen["run"](iter(batches)) for r in b.to_pylist()]
    numbers = {r["slice"] for r in rows}
    assert len(numbers) > 3 and min(numbers) == 3 << 32
    model, texts = pieces.Model(PATH), {}
    for number in numbers:
        own = sorted((r for r in rows if r["slice"] == number and r["bucket"] is not None), key=lambda r: r["bucket"])
        tiers = [np.repeat(range(pieces.TIERS - 1, -1, -1), np.frombuffer(r["runs"], "<u4")[::-1]).tolist() for r in own]
        pairs = [(t, c) for r, ts in zip(own, tiers, strict=True) for t, c in zip(ts, pieces._parted(r["blob"]), strict=True)]
        chunks = [c for _, c in sorted(pairs, key=lambda p: -p[0])]
        assert len(chunks) == len(set(chunks))
        for r in (r for r in rows if r["slice"] == number and r["doc_ids"]):
            places, at = pieces._unpacked(r["blob"]).tolist(), 0
            for i, size in zip(r["doc_ids"], r["sizes"], strict=True):
                texts[i] = [chunks[p] for p in places[at : at + size]]
                at += size
    assert texts == {r["doc_id"]: model.mark(r["text"].encode()) for r in docs.collect()}


def test_odd_rows(spark, tool, odd_docs, make_docs):
    docs = odd_docs.unionByName(make_docs([(9, "x" * 200_000, "en"), (None, None, None)]))
    both = pieces.decode(pieces.encode(docs, PATH), PATH)
    assert both.columns == ["doc_id", "ids", "decoded"]
    got = sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in both.collect()), key=str)
    want = [(r["doc_id"], tool.encode(r["text"] or "")) for r in docs.collect()]
    assert got == sorted(((i, ids, tool.decode(ids)) for i, ids in want), key=str)
    none = pieces.with_digests(pieces.decode(pieces.encode(make_docs([]), PATH), PATH), PATH)
    assert none.columns == ["doc_id", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"] and none.count() == 0


def test_decode_takes_any_rows(spark, tool):
    rows = spark.createDataFrame([(1, [259, 264]), (2, None), (3, []), (4, [0, 1, 220, 5])], "decoded int, ids array<int>")
    got = [r["decoded"] for r in pieces.decode(rows, PATH).collect()]
    assert got == ["  a", "", "", tool.decode([0, 1, 220, 5])]
    assert pieces.decode(rows, PATH, out="text").columns == ["decoded", "ids", "text"]


def test_a_word_on_a_third_of_all_places(spark, tool, make_docs):
    docs = make_docs([(i, " ".join(["the"] * 20 + [f"w{i}"] * 40), "en") for i in range(600)]).repartition(8)
    got = {r["doc_id"]: r["ids"] for r in pieces.encode(docs, PATH).select("doc_id", F.col("ids")).collect()}
    assert got == {r["doc_id"]: tool.encode(r["text"]) for r in docs.collect()}
