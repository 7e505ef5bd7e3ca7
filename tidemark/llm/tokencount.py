"""Token counts by byte-pair merging over a heap and a linked list.

Only counts come out: a text has as many tokens as it has symbols at first, less one
for each merge, and a symbol outside the vocabulary counts its bytes.
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import map_slices, raw_texts

#: Bytes of units that a worker remembers; beyond, it keeps those of one slice.
CACHE_BYTES = 96 << 20
SPACE_MARK = "▁"


class MergeCounter:
    """Counts tokens as the sentencepiece model at `path` would give them.

    `rank` orders the pieces that merges can make. Where no piece reaches over the start
    of a word, or holds a line break, the text falls into units there that are counted
    on their own and remembered.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if not any(model.is_byte(i) for i in ids):
            raise ValueError("the model needs byte fallback")
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        over_words = any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.rank)
        over_lines = any("\n" in p for p in self.rank)
        if over_words:
            self.units = re.compile(rb"(?s).+" if over_lines else rb"[^\n]+|\n")
        else:
            self.units = re.compile(rb" *[^ ]+| +" if over_lines else rb" *[^ \n]+| +|\n")
        self.known: dict[bytes, int] = {}
        self.held = 0

    def count(self, docs: list[bytes]) -> list[int]:
        """Tokens of each UTF-8 text; none for an empty one."""
        # A space before the text, and spaces and their mark alike, as the model has it.
        mark = SPACE_MARK.encode()
        units = [self.units.findall(b" " + d.replace(mark, b" ")) if d else [] for d in docs]
        used = set().union(*units)
        if self.held > CACHE_BYTES:
            self.known = {u: self.known[u] for u in used.intersection(self.known)}
            self.held = sum(120 + len(u) for u in self.known)
        for unit in used.difference(self.known):
            self.known[unit] = self.merged(unit.decode().replace(" ", SPACE_MARK))
            self.held += 120 + len(unit)
        return [sum(map(self.known.__getitem__, u)) for u in units]

    def merged(self, unit: str) -> int:
        """Symbols left once no adjacent pair makes a piece; the lowest rank merges first."""
        rank, symbols = self.rank, list(unit)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [
            (rank[pair], i, len(pair)) for i in range(n - 1) if (pair := symbols[i] + symbols[i + 1]) in rank
        ]
        heapify(heap)
        merges = 0
        while heap:
            _, left, size = heappop(heap)
            right = after[left]
            # A symbol that was merged away is empty; one that grew makes a longer pair.
            if not symbols[left] or right == n or len(symbols[left]) + len(symbols[right]) != size:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            merges += 1
            after[left] = end = after[right]
            if end < n:
                before[end] = left
                if (pair := symbols[left] + symbols[end]) in rank:
                    heappush(heap, (rank[pair], left, len(pair)))
            if (start := before[left]) >= 0 and (pair := symbols[start] + symbols[left]) in rank:
                heappush(heap, (rank[pair], start, len(pair)))
        return n - merges + sum(len(s.encode()) - 1 for s in symbols if s and s not in rank)


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    """One counter per worker process, kept from task to task."""
    return MergeCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of `docs`.

    Counts are those of the sentencepiece model at `path`, without begin or end tokens;
    strings that look like special tokens are plain text. A missing or empty text has
    no bytes and no tokens. Repeated rows are counted each; other columns are ignored;
    an empty table gives an empty one.
    """

    def make():
        tool = counter(path)

        def work(piece: pa.RecordBatch):
            docs = raw_texts(piece)
            counts = tool.count(docs)
            return {
                "doc_id": piece.column("doc_id"),
                "n_bytes": [len(t) for t in docs],
                "n_tokens": counts,
                "over_limit": [c > limit for c in counts],
            }

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return map_slices(docs.select("doc_id", "text"), out, make)
