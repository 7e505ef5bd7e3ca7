"""Benchmark passages in training text, found through suffix arrays of the text.

Each slice of documents is a shard. Its word positions are sorted by the words that
follow them (a suffix array), and every benchmark suffix is looked up in it by binary
search. The looked-up range holds all occurrences of the suffix's window; windows that
follow each other in both texts grow into the longest verbatim matches. Positions whose
next words leave the benchmark's vocabulary before a window ends cannot hold one and
stay out of the array.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, map_slices, raw_texts, slices
from tidemark.llm.rows import free_names, keep_places, placed, write_places
from tidemark.operators.ranges import totals_before
from tidemark.storage import fresh_path, materialize

#: Benchmark words that are looked up, and broadcast, at a time; an item is not parted.
BLOCK_WORDS = 1 << 21
#: Runs of ASCII letters and digits and of anything outside ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: The place of items without a name among the names.
NAMELESS = -1

MATCHES = "array<struct<item_id:string,start:bigint,n_words:bigint>>"
SPANS = "array<struct<start:bigint,end:bigint>>"


def words(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


class Probe:
    """All windows of a block of benchmark items, ready for look-up. Items without a name hit too."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items if name is not None})
        index = {name: i for i, name in enumerate(self.names)} | {None: NAMELESS}
        found: dict[tuple[int, ...], set[tuple[int, int]]] = {}
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1 if ids else 0):
                found.setdefault(tuple(ids[at : at + size]), set()).add((index[name], at))
        self.sizes = np.array([len(k) for k in found], np.int64)
        self.least = int(self.sizes.min()) if found else 0
        low = np.zeros((len(found), window), ">i4")
        high = np.full((len(found), window), -1, ">i4")
        for row, key in enumerate(found):
            low[row, : len(key)] = high[row, : len(key)] = key
        self.low, self.high = _sortable(low), _sortable(high)
        self.uses = np.array([(row, *use) for row, k in enumerate(found) for use in sorted(found[k])], np.int64)
        self.uses = self.uses.reshape(-1, 3)
        self.first_use = np.searchsorted(self.uses[:, 0], np.arange(len(found) + 1))


def _sortable(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian word numbers as byte strings that compare like the rows."""
    return np.ascontiguousarray(rows).view(f"S{4 * rows.shape[1]}").ravel()


def _spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... counts[i] times, for all i in a row."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + counts, counts)


class Found:
    """Hit words and longest matches of a shard's documents."""

    def __init__(self, docs: list[list[bytes]], probe: Probe):
        self.probe = probe
        self.sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        # One stop (0) after each document, so that no suffix crosses its end.
        self.starts = np.concatenate([[0], np.cumsum(self.sizes + 1)])
        get, ids = probe.vocabulary.get, []
        for each in docs:
            ids.extend(map(get, each, repeat(0)))
            ids.append(0)
        flat = np.array(ids, np.int32)
        self.at, self.row = self._look_up(flat)
        ends = self.at + probe.sizes[self.row]
        change = np.bincount(self.at, minlength=len(flat) + 1) - np.bincount(ends, minlength=len(flat) + 1)
        self.hit = np.cumsum(change)[: len(flat)] > 0

    def _look_up(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, window) of every occurrence of a window."""
        probe, none = self.probe, np.empty(0, np.int64)
        stops = np.flatnonzero(flat == 0)
        if not probe.least or not len(stops):
            return none, none
        runs = np.diff(np.concatenate([[-1], stops]))
        left = np.repeat(stops, runs) - np.arange(len(flat))
        positions = np.flatnonzero(left >= probe.least)
        if not len(positions):
            return none, none
        steps = np.arange(probe.window)
        inside = steps < left[positions][:, None]
        suffixes = np.where(inside, flat[np.minimum(positions[:, None] + steps, len(flat) - 1)], 0)
        keys = _sortable(suffixes.astype(">i4"))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.searchsorted(keys, probe.low, "left")
        counts = np.searchsorted(keys, probe.high, "right") - first
        return positions[order][_spread(first, counts)], np.repeat(np.arange(len(counts)), counts)

    def spans(self) -> list[list[dict[str, int]]]:
        """Per document the runs of hit words, by word position."""
        out: list[list[dict[str, int]]] = [[] for _ in self.sizes]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], self.hit, [False]]).astype(np.int8)))
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            doc = int(np.searchsorted(self.starts, begin, "right")) - 1
            out[doc].append({"start": begin - int(self.starts[doc]), "end": end - int(self.starts[doc])})
        return out

    def matches(self) -> list[list[dict[str, object]]]:
        """Per document and item the longest verbatim match and where it starts."""
        out: list[list[dict[str, object]]] = [[] for _ in self.sizes]
        if not len(self.at):
            return out
        uses = self.probe.uses
        counts = np.diff(self.probe.first_use)[self.row]
        use = _spread(self.probe.first_use[self.row], counts)
        at, item, lag = np.repeat(self.at, counts), uses[use, 1], uses[use, 2]
        named = item != NAMELESS
        at, item, lag, use = at[named], item[named], lag[named], use[named]
        if not len(at):
            return out
        order = np.lexsort((at, at - lag, item))
        at, item, lag = at[order], item[order], lag[order]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (np.diff(at) != 1) | (np.diff(item) != 0) | (np.diff(at - lag) != 0)
        begin = np.flatnonzero(fresh)
        last = np.concatenate([begin[1:], [len(at)]]) - 1
        size = at[last] - at[begin] + self.probe.sizes[uses[use[order][last], 0]]
        doc = np.searchsorted(self.starts, at[begin], "right") - 1
        best = np.lexsort((at[begin], -size, item[begin], doc))
        seen = None
        for d, i, p, n in zip(
            doc[best].tolist(), item[begin][best].tolist(), at[begin][best].tolist(), size[best].tolist(), strict=True
        ):
            if (d, i) != seen:
                seen = (d, i)
                out[d].append({"item_id": self.probe.names[i], "start": p - int(self.starts[d]), "n_words": n})
        return out


def probes(benchmark: DataFrame, window: int, block_words: int = BLOCK_WORDS) -> Iterator[tuple[bool, Probe]]:
    """The benchmark as probes of about `block_words` words each, one after the other: (the only one, probe).

    Items are numbered by running word counts and written with the block they fall in. Only one block
    at a time is at the driver, and so is its probe, if the caller lets go of those before. Items
    without words take no part, repeated rows one part; rows of one id may be in several blocks.
    """
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    size = F.size(F.regexp_extract_all(lower, F.lit(WORD.pattern.decode()), F.lit(0))).cast("bigint")
    rows = benchmark.select(F.col("item_id").cast("string").alias("name"), "text").where("text is not null").distinct()
    rows = rows.withColumn("size", size).where("size > 0")
    before = totals_before(rows, ["name", "text"], {"before": "size"})
    blocks = materialize(before.select("name", "text", F.floor(F.col("before") / block_words).alias("block")), "benchmark")
    numbers = [r["block"] for r in blocks.select("block").distinct().orderBy("block").toLocalIterator()]
    for number in numbers:
        block = blocks.where(F.col("block") == number).collect()
        yield len(numbers) == 1, Probe([(r["name"], r["text"].encode()) for r in block], window)


def _scan(docs: DataFrame, held: Broadcast, keep: list[str]) -> DataFrame:
    """`keep` with n_words, hits and matches of every row of `docs` for the broadcast probe `held`."""

    def make():
        probe = held.value

        def work(piece: pa.RecordBatch):
            tokens = [words(t) for t in raw_texts(piece)]
            found = Found(tokens, probe)
            own = {"n_words": found.sizes, "hits": found.spans(), "matches": found.matches()}
            return {c: piece.column(c) for c in keep} | own

        return work

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    out = f"{kinds}, n_words bigint, hits {SPANS}, matches {MATCHES}"
    return map_slices(docs.select(*keep, "text"), out, make)


def covered(hits: Column) -> Column:
    """Words under the union of sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        F.array_sort(hits),
        start,
        lambda acc, x: F.struct(
            (acc["total"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(acc["end"], x["start"]))).alias(
                "total"
            ),
            F.greatest(acc["end"], x["end"]).alias("end"),
        ),
        lambda acc: acc["total"],
    )


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_words, n_hit, hits, matches, contaminated) of every row of `docs`.

    A window is `window` consecutive words of an item, or all of a shorter item. `hits`
    are the spans of words inside occurrences of any window, `matches` the longest
    verbatim match per item (and block) with its word position. Items without an id hit like others, but
    are in no match. Texts that are missing, empty or without words have no words and no hits.
    Repeated rows are judged each; columns of other names are ignored; an empty benchmark or
    table gives no hits or no rows.
    """
    context = docs.sparkSession.sparkContext
    parts: list[DataFrame] = []
    names = free_names(docs, "leak_file", "leak_row")
    for only, probe in probes(benchmark, window, block_words):
        held = context.broadcast(probe)
        if only:
            return _judged(_scan(docs, held, ["doc_id"]))
        numbered = placed(docs, names) if not parts else numbered
        parts.append(materialize(_scan(numbered, held, [*names, "doc_id"]), "leaks"))
        held.unpersist()
    if not parts:
        return _judged(_scan(docs, context.broadcast(Probe([], window)), ["doc_id"]))
    # One row per block and document, so the lists are bounded.
    found = reduce(DataFrame.unionByName, parts).groupBy(*names).agg(
        F.min("doc_id").alias("doc_id"),
        F.min("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.flatten(F.collect_list("matches")).alias("matches"),
    )
    return _judged(found)


def _judged(found: DataFrame) -> DataFrame:
    return found.withColumn("n_hit", covered(F.col("hits"))).select(
        "doc_id", "n_words", "n_hit", "hits", "matches", (F.size("hits") > 0).alias("contaminated")
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of `docs` that hold no window of `benchmark`, with all their columns.

    Rows of missing, empty or wordless texts stay, and repeated rows are judged each. Items without an id count
    like others; items without words hit nothing, and an empty benchmark drops nothing. An empty table
    gives an empty one; columns may have any names. Texts are never moved: with more than one block, the
    rows that each block hits are listed by their place in the files, and one more scan leaves them out.
    """
    spark = docs.sparkSession
    names, hit = free_names(docs, "leak_file", "leak_row"), []
    for only, probe in probes(benchmark, window, block_words):
        held = spark.sparkContext.broadcast(probe)
        if only:
            return map_batches(docs, _without_hits(held), docs.schema)
        numbered = placed(docs, names) if not hit else numbered
        leaked = _scan(numbered, held, list(names)).where(F.size("hits") > 0).select(
            F.col(names[0]).alias("file"), F.col(names[1]).alias("row")
        )
        hit.append(materialize(leaked, "leaked"))
        held.unpersist()
    if not hit:
        return docs
    listed = fresh_path(spark, "leaked-rows")
    write_places(reduce(DataFrame.unionByName, hit).distinct(), listed)
    return keep_places(numbered, names, listed, keep=False)


def _without_hits(held: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            found = Found([words(t) for t in raw_texts(piece)], held.value)
            sums = np.concatenate([[0], np.cumsum(found.hit)])
            clean = sums[found.starts[1:]] == sums[found.starts[:-1]]
            yield piece.filter(pa.array(clean))

    return run
