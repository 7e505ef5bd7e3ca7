"""Concatenate all documents' tokens and cut them into fixed sequences.

The first pass turns each document into token ids and numbers them within its task. The
token totals of the tasks, summed up in order, then give every document its place in one
long row of ids; the second pass cuts each document where sequences end. Nothing is
sorted or moved between tasks.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections import Counter
from functools import lru_cache
from itertools import accumulate, chain, pairwise
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_slices, raw_texts
from tidemark.storage import materialize

#: Words looked up first, and all that a worker remembers, each in two generations.
COMMON_WORDS, KNOWN_WORDS = 16_384, 200_000
#: Longer words are not remembered.
MAX_WORD_BYTES = 48
SIGNS = string.punctuation.encode()
ALNUM = string.ascii_letters + string.digits
#: Classes of bytes: signs (s), those that may stand beside one (a: letters and digits of
#: ASCII, white space, and the bytes of À to ÿ), other ASCII (x), bytes of all else and of the
#: two signs among À to ÿ (z).
CLASSES = bytes(
    ord("s") if c in b".," else
    ord("a") if chr(c) in ALNUM or c in b" \t\n\r\v\f" or c == 0xC3 or 0x80 <= c < 0xC0 and c not in (0x97, 0xB7) else
    ord("x") if c < 0x80 else ord("z")
    for c in range(256)
)


#: What texts of ASCII and À to ÿ fall into: letters, single digits and runs of signs.
RUNS = re.compile(rb"[A-Za-z\xC3\x80-\xBF]+|[0-9]|[\x00-\x08\x0E-\x1F!-/:-@\[-`{-\x7F]+").findall


def pieces(text: bytes, signs: list[bytes]) -> list[bytes]:
    """Words, and signs apart from them where that is plain to see.

    If no full stop or comma can stand beside another sign, these `signs` are set apart.
    Otherwise, a text of ASCII and À to ÿ alone falls into runs; one with an apostrophe
    or other characters is left as it is.
    """
    seen = text.translate(CLASSES)
    if b"z" in seen:
        return text.split()
    if not any(x in seen for x in (b"ss", b"sx", b"xs")):
        for sign in signs:
            text = text.replace(sign, b" " + sign + b" ")
        return text.split()
    return text.split() if b"'" in text else RUNS(text)


#: Lower-case letters of Latin scripts whose words the model gets directly.
LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c.islower() and c == normalize("NFC", c))


class WordEncoder:
    """Ids of a tokenizer that never joins what white space parts.

    Texts are split at ASCII white space and each different word is encoded once; a
    memory of bounded size holds the words' ids between texts. What a tokenizer is seen
    to do with single characters saves work on whole words: where it lower-cases, words
    are remembered in lower case; where it parts signs from the letter or digit beside
    them, as the word and its signs; and where its first steps leave a word of lower-case
    letters whole, the merges get it without them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = tool = Tokenizer.from_file(path)
        self.code = "H" if tool.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.common: dict[bytes, bytes] = {}
        self.marks = [t.content.lower().encode() for t in tool.get_added_tokens_decoder().values()]
        norm, parts = tool.normalizer, tool.pre_tokenizer
        self.lowers = bool(norm) and norm.normalize_str(string.ascii_uppercase) == string.ascii_lowercase
        self.loose = bytes(
            s for s in SIGNS if parts and all(len(parts.pre_tokenize_str(c + chr(s))) == 2 for c in ALNUM)
        )
        self.parted = [
            bytes([s]) for s in b".,"
            if parts and all(len(parts.pre_tokenize_str(f"{c}{chr(s)}{c}7##")) == 5 for c in ALNUM + "éÀ")
        ]
        self.model, self.spelled = tool.model, {}
        if norm and parts and norm.normalize_str(LETTERS) == LETTERS and len(parts.pre_tokenize_str(LETTERS)) == 1:
            self.spelled = {ord(c): parts.pre_tokenize_str(c)[0][0] for c in LETTERS}
        self.plain = re.compile(f"[{LETTERS}]+" if self.spelled else r"(?!)").fullmatch

    def _words(self, text: bytes) -> list[bytes]:
        low = text.lower()
        # Special strings are told by their case.
        if any(m in low for m in self.marks):
            return text.split()
        # Some marks (lead bytes CC and CD) compose with small letters only, and the
        # tokenizer composes before it lower-cases.
        if self.lowers and not (b"\xcc" in text or b"\xcd" in text):
            text = low
        return pieces(text, self.parted) if self.parted == [b".", b","] else text.split()

    def _spell(self, word: bytes) -> bytes:
        """Ids of a word, from the merges alone where its first steps are known."""
        text = word.decode()
        # LETTERS are composed, so a word of them has no marks to compose.
        if self.plain(text):
            tokens = self.model.tokenize(text if text.isascii() else text.translate(self.spelled))
            return array(self.code, [t.id for t in tokens]).tobytes()
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _ids(self, word: bytes) -> bytes:
        """Ids of a word that is not remembered as it stands, or not in this generation."""
        if word[-1] in self.loose:
            base = word.rstrip(self.loose)
            if base and chr(base[-1]) in ALNUM and not any(m in word.lower() for m in self.marks):
                signs = word[len(base) :]
                return (self.known.get(base) or self._ids(base)) + (self.known.get(signs) or self._ids(signs))
        ids = self.known.get(word) or self.older.get(word) or self._spell(word)
        if len(word) <= MAX_WORD_BYTES:
            self.known[word] = ids
        return ids

    def encode(self, docs: list[bytes], end_id: int) -> list[bytes]:
        """Little-endian ids of each document, `end_id` last, `width` bytes each."""
        words = [self._words(d) for d in docs]
        flat = list(chain.from_iterable(words))
        if len(self.known) > KNOWN_WORDS or not self.common:
            self.known, self.older = {}, self.known
            top = Counter(flat).most_common(COMMON_WORDS)
            self.common = {w: self._ids(w) for w, _ in top if len(w) <= MAX_WORD_BYTES}
        # Most words are among a few thousand, whose table stays in the processor's cache.
        ids = list(map(self.common.get, flat))
        rare = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(rare, map(self.known.get, [flat[i] for i in rare]), strict=True):
            ids[i] = x or self._ids(flat[i])
        end, edges = array(self.code, [end_id]).tobytes(), accumulate(map(len, words), initial=0)
        return [b"".join(ids[a:b]) + end for a, b in pairwise(edges)]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process, kept from task to task."""
    return WordEncoder(path)


def token_rows(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(part, doc_id, before, doc_tokens, width, ids) of every row of `docs`.

    `before` counts the ids of earlier rows of the same task `part`; `width` is the
    number of bytes of an id.
    """

    def make():
        tool, part, total = encoder(path), TaskContext.get().partitionId(), 0

        def work(piece: pa.RecordBatch):
            nonlocal total
            ids = tool.encode(raw_texts(piece), end_id)
            width = tool.width
            sizes = [len(x) // width for x in ids]
            before = list(accumulate(sizes, initial=total))
            total = before.pop()
            n = len(ids)
            return {
                "part": [part] * n, "doc_id": piece.column("doc_id"), "before": before, "doc_tokens": sizes,
                "width": [width] * n, "ids": ids,
            }

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"part int, doc_id {kind}, before bigint, doc_tokens bigint, width int, ids binary"
    return map_slices(docs.select("doc_id", "text"), out, make)


def cut_points(first: int, size: int, length: int) -> list[tuple[int, int]]:
    """(start, end) within a document that begins at `first` of the long row."""
    edges = [0, *range(length - first % length, size, length), size]
    return list(zip(edges[:-1], edges[1:], strict=True))


def pack(docs: DataFrame, path: str, end_id: int = 2, length: int = 4096) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of all rows.

    A document's ids are those of the tokenizer at `path` without special ones, then
    `end_id`. `start` counts its ids before the piece, `ids` holds the piece's ids as
    little-endian unsigned 32-bit numbers. All sequences but the last are full. A
    missing or empty text is `end_id` alone; a missing doc_id stays missing; repeated
    rows are packed as often as they come; other columns are ignored; an empty table
    gives no pieces.
    """
    rows = materialize(token_rows(docs, path, end_id), "tokens")
    # One number per task of the first pass.
    totals = sorted(rows.groupBy("part").agg(F.sum("doc_tokens")).collect())
    offsets = dict(
        zip([p for p, _ in totals], accumulate([n for _, n in totals], initial=0), strict=False)
    )
    held = docs.sparkSession.sparkContext.broadcast(offsets)

    def make():
        offsets = held.value

        def work(piece: pa.RecordBatch):
            columns = [piece.column(c).to_pylist() for c in ("part", "before", "doc_tokens", "width", "ids")]
            row, start, size, sequence, offset, out = [], [], [], [], [], []
            for i, (part, before, count, width, raw) in enumerate(zip(*columns, strict=True)):
                first = offsets[part] + before
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                for begin, end in cut_points(first, count, length):
                    row.append(i)
                    start.append(begin)
                    size.append(end - begin)
                    sequence.append((first + begin) // length)
                    offset.append((first + begin) % length)
                    out.append(ids[begin:end].tobytes())
            at = pa.array(row, pa.int64())
            return {
                "doc_id": piece.column("doc_id").take(at), "start": start, "length": size,
                "doc_tokens": piece.column("doc_tokens").take(at), "sequence_id": sequence, "offset": offset,
                "ids": out,
            }

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = (
        f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
        "offset bigint, ids binary"
    )
    return map_slices(rows, out, make, column="ids")


def with_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in the ids' place."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
