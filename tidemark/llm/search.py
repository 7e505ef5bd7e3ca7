"""Ranked lexical search: accumulators of short lists as one list among the long ones.

Documents are indexed in shards: for each term its documents there and how often they hold
it. A query adds up its short lists term at a time into accumulators; these are then one
more list, bounded by their largest sum, and are walked together with the long lists
document at a time. Lists that cannot lift a document above the query's tenth best score
are not walked, only probed for the documents that the others bring up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tidemark.llm.common import map_batches, raw_texts, slices
from tidemark.storage import materialize

#: Terms: letters and digits of ASCII, and all beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes to lower case, and those between terms to spaces.
_FOLD = bytes(
    (c | 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20) for c in range(256)
)
#: A shard ends after so many bytes of text or documents.
SHARD_BYTES, SHARD_DOCS = 8 << 20, 1 << 15
#: Bits of the filter of asked terms that goes to all tasks: 128 KB, whatever is asked.
FILTER_BITS = 20
#: Query terms that go to all tasks at a time; a query is not parted.
BLOCK_TERMS = 100_000
#: A list in at most this share of a shard's documents, or so many of them, is short.
SHORT_SHARE, SHORT_LIST = 1 / 32, 16
#: Documents walked between two looks at the lists' bounds.
STRIDE = 1024
#: Parts into which a query's finds are ranked first.
SALTS = 64


def text_terms(text: Column) -> Column:
    """The terms of a text in order, only A-Z lower-cased; none of a missing text."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each once. Rows of one item_id are one item; a missing id is one, too."""
    return items.select("item_id", F.explode(text_terms(F.col("text"))).alias("term")).distinct()


def _slot(term: Column) -> Column:
    return F.crc32(term.cast("binary")) % F.lit(1 << FILTER_BITS)


def asked_filter(terms: DataFrame) -> bytes:
    """A bit for each hash of a term: a filter of fixed size, however many terms there are."""
    slots = terms.select(_slot(F.col("term")).alias("slot")).distinct().toArrow()["slot"].to_numpy()
    bits = np.zeros(1 << FILTER_BITS, np.uint8)
    bits[slots] = 1
    return np.packbits(bits).tobytes()


SHARD = "shard bigint, term string, df bigint, tf_max bigint, n_min bigint, docs binary, tfs binary"


def index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Shards of all rows of `docs`.

    A row without `term` lists a shard's documents: doc_ids, and lengths n in terms. The others are
    postings: the documents of a term by place in the shard (32 bits each), how often they
    hold it, the largest of these numbers and the least length. Only terms that pass the filter of
    `terms` have postings. Texts are read once and whole.
    """
    held = docs.sparkSession.sparkContext.broadcast(asked_filter(terms))
    kind = StructType(
        [
            *StructType.fromDDL(SHARD), StructField("doc_ids", ArrayType(docs.schema["doc_id"].dataType)),
            StructField("lengths", ArrayType(LongType())),
        ]
    )
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.unpackbits(np.frombuffer(held.value, np.uint8))
        build = _ShardBuilder(asked, TaskContext.get().partitionId() << 32, schema)
        for piece in slices(batches, "text", SHARD_BYTES):
            yield from build.add(piece)
        yield from build.flush()

    return map_batches(docs.select("doc_id", "text"), run, kind)


class _ShardBuilder:
    """Collects documents and gives out whole shards."""

    def __init__(self, asked: np.ndarray, number: int, schema: pa.Schema):
        self.asked, self.number, self.schema = asked, number, schema
        self._clear()

    def _clear(self) -> None:
        self.doc_ids, self.lengths, self.bytes = [], [], 0
        self.places: dict[bytes, int] = {}
        self.terms, self.docs, self.counts = [], [], []

    def add(self, piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for doc_id, text in zip(piece.column("doc_id").to_pylist(), raw_texts(piece), strict=True):
            words = text.translate(_FOLD).split()
            for word in set(words).difference(self.places):
                passes = self.asked[zlib.crc32(word) & ((1 << FILTER_BITS) - 1)]
                self.places[word] = len(self.places) if passes else -1
            found = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
            terms, counts = np.unique(found[found >= 0], return_counts=True)
            self.terms.append(terms)
            self.counts.append(counts)
            self.docs.append(np.full(len(terms), len(self.doc_ids), "<u4"))
            self.doc_ids.append(doc_id)
            self.lengths.append(len(words))
            self.bytes += len(text)
            if self.bytes >= SHARD_BYTES or len(self.doc_ids) >= SHARD_DOCS:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.doc_ids:
            return
        yield self._batch(1, shard=[self.number], doc_ids=[self.doc_ids], lengths=[self.lengths])
        terms, docs, tfs = (np.concatenate(x) for x in (self.terms, self.docs, self.counts))
        if len(terms):
            order = np.argsort(terms, kind="stable")
            terms, docs, tfs = terms[order], docs[order], tfs[order].astype("<u4")
            starts = np.flatnonzero(np.diff(terms, prepend=-1))
            ends = np.append(starts[1:], len(terms))
            # A number per word of the shard, with gaps for those that do not pass.
            words = {place: word for word, place in self.places.items() if place >= 0}
            offsets = pa.py_buffer((4 * np.append(starts, len(terms))).astype(np.int32).tobytes())
            yield self._batch(
                len(starts),
                shard=np.full(len(starts), self.number),
                term=[words[t].decode() for t in terms[starts].tolist()],
                df=ends - starts,
                tf_max=np.maximum.reduceat(tfs, starts).astype(np.int64),
                n_min=np.minimum.reduceat(np.array(self.lengths)[docs], starts),
                docs=pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(docs.tobytes())]),
                tfs=pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(tfs.tobytes())]),
            )
        self.number += 1
        self._clear()

    def _batch(self, n: int, **columns) -> pa.RecordBatch:
        arrays = []
        for f in self.schema:
            values = columns.get(f.name)
            values = pa.nulls(n, f.type) if values is None else values
            arrays.append(values.cast(f.type) if isinstance(values, pa.Array) else pa.array(values, f.type))
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def weighed(terms: DataFrame, shards: DataFrame, n_docs: int) -> DataFrame:
    """(item_id, term, w) of the query terms that documents hold."""
    df = shards.where("term is not null").groupBy("term").agg(F.sum("df").alias("df"))
    share = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    return terms.join(df, "term").select("item_id", "term", F.floor(F.ln(share) * 1000).alias("w")).where("w > 0")


@dataclass
class Postings:
    """One term's documents in a shard."""

    docs: np.ndarray
    tfs: np.ndarray
    tf_max: int
    m_min: int

    def part(self, at: np.ndarray | slice, m: np.ndarray) -> np.ndarray:
        """What a document gets of the term's weight, in millionths: (10^9 tf) div (1000 tf + 8 m)."""
        tf = self.tfs[at].astype(np.int64)
        return 1_000_000_000 * tf // (1000 * tf + 8 * m[self.docs[at]])


@dataclass
class Best:
    """A query's best documents so far: (score, id), and the score to reach."""

    size: int
    found: list[tuple[int, object]] = field(default_factory=list)
    least: int = 1

    def offer(self, scores: np.ndarray, ids: list) -> None:
        """Take in documents with at least the score to reach; equal scores go by id, missing ids last."""
        self.found += zip(scores.tolist(), ids, strict=True)
        if len(self.found) > self.size:
            self.found.sort(key=lambda f: (-f[0], f[1] is None, f[1]))
            del self.found[self.size :]
        if len(self.found) == self.size:
            self.least = max(1, min(s for s, _ in self.found))


def damping(lengths: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """m of documents with so many terms: 100 - 90 + (90 n N) div L."""
    return 10 + 90 * lengths.astype(np.int64) * n_docs // max(total, 1)


def rank_shard(lists: list[tuple[int, Postings]], m: np.ndarray, doc_ids: list, best: Best) -> None:
    """Offer a shard's documents for the (weight, postings) of one query to `best`.

    No document is left out whose score could be among the best: lists are only set aside
    while their bounds together stay below the score to reach.
    """
    if not lists:
        return
    longest = max(SHORT_LIST, int(len(m) * SHORT_SHARE))
    total = np.zeros(len(m), np.int64)
    walked: list[tuple[int, int, Postings | None]] = []
    for w, p in lists:
        if len(p.docs) <= longest:
            total[p.docs] += w * p.part(slice(None), m)
        else:
            # More occurrences and a shorter text only add to a score.
            walked.append((w * (1_000_000_000 * p.tf_max // (1000 * p.tf_max + 8 * p.m_min)), w, p))
    summed = np.flatnonzero(total)
    if len(summed):
        walked.append((int(total.max()), 0, None))
    # Lists by ascending bound, with the sums of the bounds up to each.
    walked.sort(key=lambda x: x[0])
    bounds = list(accumulate((b for b, _, _ in walked), initial=0))
    if bounds[-1] < best.least:
        return
    for start in range(0, len(m), STRIDE):
        # The first lists, whose bounds together stay below the score to reach, bring up no document.
        aside = next(i for i in range(len(bounds) - 1, -1, -1) if bounds[i] < best.least)
        if aside == len(walked):
            return
        stop = min(start + STRIDE, len(m))
        score = np.zeros(stop - start, np.int64)
        seen = np.zeros(stop - start, bool)
        for _, w, p in walked[aside:]:
            if p is None:
                score += total[start:stop]
                seen |= total[start:stop] > 0
            else:
                a, b = np.searchsorted(p.docs, (start, stop))
                at = p.docs[a:b] - start
                score[at] += w * p.part(slice(a, b), m)
                seen[at] = True
        docs = np.flatnonzero(seen)
        for i in range(aside - 1, -1, -1):
            # Bounds of this list and those before it: what a document may still get.
            docs = docs[score[docs] + bounds[i + 1] >= best.least]
            if not len(docs):
                break
            _, w, p = walked[i]
            if p is None:
                score[docs] += total[docs + start]
            else:
                at = np.minimum(np.searchsorted(p.docs, docs + start), len(p.docs) - 1)
                hit = p.docs[at] == docs + start
                score[docs[hit]] += w * p.part(at[hit], m)
        docs = docs[score[docs] >= best.least]
        if len(docs):
            best.offer(score[docs], [doc_ids[d + start] for d in docs.tolist()])


def _blocks(queries: DataFrame, limit: int) -> Iterator[list[Row]]:
    """The written queries (item_id, terms) in blocks of at most `limit` terms (or one query), one at a time."""
    block, size = [], 0
    for row in queries.toLocalIterator():
        if block and size + len(row["terms"]) > limit:
            yield block
            block, size = [], 0
        block.append(row)
        size += len(row["terms"])
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents of each item with a score above 0.

    Scores are those of `rank_shard` with weights floor(1000 ln((2N+2)/(2df+1))) over all rows of
    `docs`. Rows with one item_id are one item, a missing one included, whose terms count once; a
    missing or empty text has none. Equal scores go by doc_id, missing ids last; rows of `docs`
    that repeat an id are documents of their own. Items without a hit are not in the
    result; empty tables give an empty one; other columns are ignored.
    """
    spark = docs.sparkSession
    terms = materialize(query_terms(items), "query-terms")
    shards = materialize(index(docs, terms), "shards")
    listed = shards.where("term is null")
    size = F.explode("lengths").alias("n")
    n_docs, total = listed.select(size).agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = materialize(weighed(terms, shards, n_docs), "weights")
    grouped = weights.groupBy("item_id").agg(F.collect_list(F.struct("term", "w")).alias("terms"))
    queries = materialize(grouped, "queries")
    kind = StructType([items.schema["item_id"], docs.schema["doc_id"], StructField("score", LongType()), StructField("part", IntegerType())])
    found = spark.createDataFrame([], kind)
    for block in _blocks(queries, BLOCK_TERMS):
        held = spark.sparkContext.broadcast([(q["item_id"], [(t["term"], t["w"]) for t in q["terms"]]) for q in block])
        used = spark.createDataFrame([(t,) for t in {t["term"] for q in block for t in q["terms"]}], "term string")
        postings = shards.where("term is not null").join(used, "term", "left_semi").select(shards.columns)
        together = postings.unionByName(listed).repartition("shard").sortWithinPartitions("shard", F.col("term").isNotNull())
        ranked = map_batches(together, _rank_run(held, kind, n_docs, total, top), kind)
        found = found.unionByName(materialize(ranked, "finds"))
        held.unpersist()
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    first = Window.partitionBy("item_id", "part").orderBy(*order)
    last = Window.partitionBy("item_id").orderBy(*order)
    few = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    ranks = few.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= top)
    return ranks.select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def _rank_run(held, kind: StructType, n_docs: int, total: int, top: int):
    """The task that ranks its shards, one after the other, for all queries of a block."""
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = held.value
        best = [Best(top) for _ in queries]
        part = TaskContext.get().partitionId() % SALTS
        now, ids, m, lists = None, [], np.empty(0, np.int64), {}

        def rank() -> None:
            for (_, terms), b in zip(queries, best, strict=True):
                rank_shard([(w, lists[t]) for t, w in terms if t in lists], m, ids, b)

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != now:
                    rank()
                    now, ids, lists = row["shard"], row["doc_ids"], {}
                    m = damping(np.array(row["lengths"], np.int64), n_docs, total)
                else:
                    docs, tfs = (np.frombuffer(row[c], "<u4").astype(np.int64) for c in ("docs", "tfs"))
                    least = int(damping(np.array([row["n_min"]]), n_docs, total)[0])
                    lists[row["term"]] = Postings(docs, tfs, row["tf_max"], least)
        rank()
        finds = [(item, doc, score, part) for (item, _), b in zip(queries, best, strict=True) for score, doc in b.found]
        columns = list(zip(*finds)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run
