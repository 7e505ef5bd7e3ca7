import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import packing, tokencount

PIECE, WORD = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "a", "the", "Then", " ", "  ", "\n", "\t", "▁", "é", "é", "́", "中", "😀", "<s>", "</s>", "<|endoftext|>",
    "<|EndOfText|>", "<0x41>", "'s", "'T", "1", "İ", "Σ", "ß", "\x00", "\x1c", "\x85", "\xa0", "\r\n", ".", ",", "...",
    ".,", "!!", "ﬁ", "가", "<unk>",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 18))) for _ in range(1500)]


def test_counts_are_those_of_sentencepiece(make_docs, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    rows = tokencount.count_tokens(make_docs([(i, t, "en") for i, t in enumerate(texts)]), PIECE, limit=10).collect()
    for r in rows:
        want = len(model.encode(texts[r["doc_id"]]))
        assert (r["n_tokens"], r["over_limit"]) == (want, want > 10), texts[r["doc_id"]]
        assert r["n_bytes"] == len(texts[r["doc_id"]].encode())


def test_counts_hold_with_little_memory(texts, monkeypatch):
    whole = tokencount.MergeCounter(PIECE).count([t.encode() for t in texts])
    monkeypatch.setattr(tokencount, "CACHE_BYTES", 0)
    small = tokencount.MergeCounter(PIECE)
    assert [small.count([t.encode()])[0] for t in texts] == whole


def test_one_long_word_is_counted(texts):
    import sentencepiece

    word = "thequick" * 20_000
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    assert tokencount.MergeCounter(PIECE).count([word.encode()]) == [len(model.encode(word))]


def encoded(tool, texts, end_id):
    return [np.frombuffer(x, f"<u{tool.width}").tolist() for x in tool.encode([t.encode() for t in texts], end_id)]


def test_ids_are_those_of_the_tokenizer(texts, monkeypatch):
    from tokenizers import Tokenizer

    want = [e.ids + [2] for e in Tokenizer.from_file(WORD).encode_batch(texts, add_special_tokens=False)]
    assert encoded(packing.WordEncoder(WORD), texts, 2) == want
    monkeypatch.setattr(packing, "KNOWN_WORDS", 0)
    monkeypatch.setattr(packing, "COMMON_WORDS", 1)
    small = packing.WordEncoder(WORD)
    assert [encoded(small, [t], 2)[0] for t in texts] == want


def test_plain_texts_with_many_signs():
    from tokenizers import Tokenizer

    rng = random.Random(4)
    parts = ["a", "The", "é", "ÿ", "7", "42", ".", ",", "!!", "###", "'s", "'", "|", "<|", "×", "÷", " ", "\n", "\x00", "\x1f", "\x7f"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    want = [e.ids + [2] for e in Tokenizer.from_file(WORD).encode_batch(texts, add_special_tokens=False)]
    assert encoded(packing.WordEncoder(WORD), texts, 2) == want


def test_pieces_rebuild_every_document(make_docs, texts):
    docs = [(i, t, "en") for i, t in enumerate(texts)] + [(9999, "word " * 3000, "en"), (9998, None, None)]
    rows = packing.pack(make_docs(docs).repartition(5), WORD, end_id=2, length=64).collect()
    spots = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    sizes = {}
    for sequence, offset, length in spots:
        assert offset == sizes.get(sequence, 0)
        sizes[sequence] = offset + length
    assert [sizes[s] for s in range(len(sizes) - 1)] == [64] * (len(sizes) - 1) and sizes[len(sizes) - 1] <= 64
    tool = packing.WordEncoder(WORD)
    for doc_id, text, _ in docs:
        own = sorted((r["start"], r["length"], bytes(r["ids"]), r["doc_tokens"]) for r in rows if r["doc_id"] == doc_id)
        ids = np.frombuffer(b"".join(x[2] for x in own), "<u4").tolist()
        assert ids == encoded(tool, [text or ""], 2)[0] and {x[3] for x in own} == {len(ids)}
        assert [x[0] for x in own] == np.cumsum([0] + [x[1] for x in own[:-1]]).tolist()


def test_digests(make_docs):
    row = packing.with_digest(packing.pack(make_docs([(1, "", "en")]), WORD)).first()
    assert row["ids_crc32"] == zlib.crc32(np.array([2], "<u4").tobytes())
    assert (row["start"], row["length"], row["doc_tokens"], row["sequence_id"], row["offset"]) == (0, 1, 1, 0, 0)


def test_odd_rows(odd_docs, make_docs):
    counts = sorted((r["doc_id"] or 0, r["n_tokens"]) for r in tokencount.count_tokens(odd_docs, PIECE).collect())
    assert len(counts) == 8 and counts[1:3] == [(1, 0), (2, 0)] and counts[4][1] > 60_000 - 1
    assert packing.pack(odd_docs, WORD).groupBy().sum("length").first()[0] == 60_000 + 8 + sum(
        len(x) - 1 for x in encoded(packing.WordEncoder(WORD), ["the same text here"] * 2 + ["no id at all 12", "12345 !!! ???"], 2)
    )
    none = make_docs([])
    assert tokencount.count_tokens(none, PIECE).count() == packing.pack(none, WORD).count() == 0


def test_marks_after_capitals_equal_the_library():
    """Marks that compose with a small letter and not with its capital, and random ones."""
    from tokenizers import Tokenizer

    rng = random.Random(8)
    tool, encoder = Tokenizer.from_file(WORD), packing.WordEncoder(WORD)
    marks = [chr(c) for c in range(0x300, 0x370)] + ["᷄", "⃗", "︠"]
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZÀßİıſKÅΣς"
    rest = [" ", ".", ",", "'s", "-", "!", "7", "\n", "×", "ʾ", "가", "中", " the "]
    texts = ["J̌", "T̈", "W̊", "Y̊", "H̱", "J̌. T̈, W̊!"]
    for _ in range(20_000):
        parts = []
        for _ in range(rng.randrange(1, 8)):
            parts += [rng.choice(letters), *rng.choices(marks, k=rng.choice((0, 0, 1, 2))), rng.choice(["", "", *rest])]
        texts.append("".join(parts))
    for start in range(0, len(texts), 500):
        part = texts[start : start + 500]
        found = encoder.encode([t.encode() for t in part], 2)
        for own, whole in zip(found, tool.encode_batch(part, add_special_tokens=False), strict=True):
            assert np.frombuffer(own, "<u2").tolist() == [*whole.ids, 2]
