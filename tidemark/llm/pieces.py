"""SentencePiece encoding through a table of distinct chunks, and decoding.

Where no piece of a model reaches over the start of a marked word, a text's segmentation
is that of its words, one after the other. Tasks replace texts by the places of their
words in a list of the slice's distinct ones; the lists, cut by a hash of the word, are
brought together, so that each distinct word is segmented once; and its ids go back to
the slices, where they are joined to the texts by position. The texts' places never move.
"""

from __future__ import annotations

import posixpath
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm.common import map_batches, raw_texts, slices
from tidemark.llm.warc import place
from tidemark.storage import fresh_path, materialize

SPACE_MARK = "▁".encode()
#: A slice ends after so many distinct chunks, or chunks in all.
SLICE_CHUNKS, SLICE_PLACES = 600_000, 12_000_000
#: Tiers of a slice's chunks by the binary logarithm of their count there.
TIERS = 32
#: Distinct chunks whose ids a task of the table remembers at a time.
KNOWN_CHUNKS = 2_000_000
#: Ids of a document turned to decimal text at a time.
DIGEST_IDS = 1 << 20


class Model:
    """A sentencepiece model whose pieces do not reach over the start of a marked word."""

    def __init__(self, path: str):
        import sentencepiece

        self.tool = tool = sentencepiece.SentencePieceProcessor(model_file=path)
        size = tool.get_piece_size()
        self.pieces = [tool.id_to_piece(i).encode() for i in range(size)]
        text = [p for i, p in enumerate(self.pieces) if not (tool.is_control(i) or tool.is_unknown(i))]
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in text):
            raise ValueError("pieces reach over the start of a word")
        # No piece holds a guard sign, so what follows it is segmented on its own.
        guards = (s for s in "\n\x01\x02" if not any(s.encode() in p for p in text))
        self.guard = next(guards, "")
        probe = f"  ①{self.guard} ﬁ  x "
        if not self.guard or tool.decode(tool.encode(probe)) != probe:
            raise ValueError("the model changes texts before it segments them")
        self.before = len(tool.encode(self.guard))
        self.code = "<u2" if size <= 1 << 16 else "<u4"
        stop = re.escape(self.guard.encode())
        self.chunks = re.compile(rb" *[^ %b]+| +|%b" % (stop, stop)).findall

    def mark(self, text: bytes) -> list[bytes]:
        """The marked words of a text, a space for the mark; the model puts one before the text."""
        return self.chunks(b" " + text.replace(SPACE_MARK, b" ")) if text else []

    def segment(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of each chunk as numbers of type `code`."""
        found = self.tool.encode([self.guard + c.decode() for c in chunks], num_threads=1)
        return [np.array(ids[self.before :], self.code).tobytes() for ids in found]


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """One model per worker process, kept from task to task."""
    return Model(path)


class _Places(dict):
    """Chunk -> its number, by first sight."""

    def __missing__(self, chunk: bytes) -> int:
        number = self[chunk] = len(self)
        return number


def _packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers of 4 bytes, compressed byte by byte place, as high bytes are mostly alike."""
    flat = np.concatenate([a.astype("<u4") for a in arrays]) if arrays else np.empty(0, "<u4")
    return zstandard.compress(flat.view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _joined(parts: list[bytes]) -> bytes:
    """Byte strings as one compressed string: how many, their lengths, themselves."""
    sizes = np.fromiter(map(len, parts), "<u4", len(parts))
    return zstandard.compress(np.uint32(len(parts)).tobytes() + sizes.tobytes() + b"".join(parts), 3)


def _lengths_and_rest(blob: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    return np.frombuffer(raw, "<u4", n, 4), raw[4 + 4 * n :]


def _parted(blob: bytes) -> list[bytes]:
    sizes, rest = _lengths_and_rest(blob)
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    return [rest[a:b] for a, b in pairwise([0, *ends])]


def _row_batch(schema: pa.Schema, **columns: list) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns.get(f.name, [None] * n), f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def mark_rows(docs: DataFrame, path: str, buckets: int) -> DataFrame:
    """Texts as places of their chunks, and each slice's distinct chunks.

    Rows with `doc_ids` hold some documents: their ids, the chunks of each, and the places of
    the chunks in the slice's list, compressed. Rows with `bucket` hold the part of that list
    whose hash falls there. The list is in tiers, chunks of twice the count before others, so
    that frequent places are small numbers; a tier is its parts by ascending bucket, and
    `runs` has how many of a part's chunks are in each tier.
    """
    kind = StructType(
        [
            StructField("slice", LongType()), StructField("bucket", IntegerType()), StructField("blob", BinaryType()),
            StructField("runs", BinaryType()), StructField("doc_ids", ArrayType(docs.schema["doc_id"].dataType)), StructField("sizes", ArrayType(LongType())),
        ]
    )
    schema = to_arrow_schema(kind)

    def flush(number: int, table: _Places, held: list[tuple[list, list[int], np.ndarray]]) -> Iterator[pa.RecordBatch]:
        lists: dict[int, list[bytes]] = {}
        for chunk in table:
            lists.setdefault(zlib.crc32(chunk) % buckets, []).append(chunk)
        tiers = np.frexp(np.bincount(np.concatenate([p for _, _, p in held]), minlength=len(table)))[1] - 1
        listed = [np.empty(0, np.int64)]
        for bucket in sorted(lists):
            part = sorted(lists[bucket])
            own = np.fromiter(map(table.__getitem__, part), np.int64, len(part))
            by = np.argsort(-tiers[own], kind="stable")
            runs = np.bincount(tiers[own], minlength=TIERS).astype("<u4").tobytes()
            yield _row_batch(schema, slice=[number], bucket=[bucket], blob=[_joined([part[i] for i in by.tolist()])], runs=[runs])
            listed.append(own[by])
        numbers = np.concatenate(listed)
        order = np.empty(len(table), np.uint32)
        order[numbers[np.argsort(-tiers[numbers], kind="stable")]] = np.arange(len(table))
        for ids, sizes, places in held:
            yield _row_batch(schema, slice=[number], blob=[_packed(order[places])], doc_ids=[ids], sizes=[sizes])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, number = model(path), TaskContext.get().partitionId() << 32
        table, held, count = _Places(), [], 0
        for piece in slices(batches, "text"):
            words = [tool.mark(t) for t in raw_texts(piece)]
            sizes = [len(w) for w in words]
            places = np.fromiter((table[c] for w in words for c in w), np.uint32, sum(sizes))
            held.append((piece.column("doc_id").to_pylist(), sizes, places))
            count += len(places)
            if len(table) >= SLICE_CHUNKS or count >= SLICE_PLACES:
                yield from flush(number, table, held)
                number, table, held, count = number + 1, _Places(), [], 0
        if held:
            yield from flush(number, table, held)

    return map_batches(docs.select("doc_id", "text"), run, kind)


def segment_chunks(lists: DataFrame, path: str) -> DataFrame:
    """(slice, bucket, blob, runs) with the ids of the chunks in their place.

    All lists of a bucket come to one task, where each distinct chunk is segmented once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, now, known = model(path), None, {}
        for batch in batches:
            for number, bucket, blob, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now or len(known) > KNOWN_CHUNKS:
                    now, known = bucket, {}
                chunks = _parted(blob)
                new = [c for c in chunks if c not in known]
                known.update(zip(new, tool.segment(new), strict=True))
                ids = _joined([known[c] for c in chunks])
                yield _row_batch(batch.schema, slice=[number], bucket=[bucket], blob=[ids], runs=[runs])

    together = lists.select("slice", "bucket", "blob", "runs").repartition("bucket").sortWithinPartitions("bucket")
    return map_batches(together, run, together.schema)


class _Table:
    """The ids of a slice's chunks by place."""

    def __init__(self, root: str, number: int, code: str):
        files, folder = place(root)
        found = files.get_file_info(fs.FileSelector(posixpath.join(folder, f"slice={number}"), allow_not_found=True))
        names = [f.path for f in found if f.is_file and f.base_name.endswith(".parquet")]
        rows = [r for n in names for r in pq.read_table(n, filesystem=files, partitioning=None).to_pylist()]
        rows.sort(key=lambda r: r["bucket"])
        parts = [_lengths_and_rest(r["blob"]) for r in rows]
        runs = [np.frombuffer(r["runs"], "<u4")[::-1] for r in rows]
        descending = np.concatenate([np.repeat(np.arange(len(r)), r) for r in runs] or [np.empty(0, np.int64)])
        order = np.argsort(descending, kind="stable")
        sizes = np.concatenate([p[0] for p in parts] or [np.empty(0, "<u4")]).astype(np.int64) // np.dtype(code).itemsize
        self.ids = np.frombuffer(b"".join(p[1] for p in parts), code)
        self.sizes, self.starts = sizes[order], (np.cumsum(sizes) - sizes)[order]


@lru_cache(maxsize=2)
def _table(root: str, number: int, code: str) -> _Table:
    return _Table(root, number, code)


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of `values` that begin at `starts`, one after the other."""
    ends = np.cumsum(sizes)
    shift = starts - (ends - sizes)
    return values[np.repeat(shift, sizes) + np.arange(ends[-1] if len(ends) else 0)]


def _sums(values: np.ndarray, sizes: list[int]) -> np.ndarray:
    """The sums of runs of `values`."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - np.array(sizes, np.int64)]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row of `docs`, as the sentencepiece model at `path` has them.

    Without begin or end ids; strings that look like special pieces are plain text. A
    missing or empty text has no ids. A missing doc_id stays missing; repeated rows are
    encoded each; other columns are ignored; an empty table gives an empty one. A model
    whose pieces reach over the start of a word, or that changes texts first, is refused.
    """
    spark = docs.sparkSession
    code = model(path).code
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = materialize(mark_rows(docs, path, buckets), "marked")
    root = fresh_path(spark, "chunk-ids")
    ids = segment_chunks(marked.where(F.col("bucket").isNotNull()), path)
    ids.repartition("slice").write.option("compression", "none").partitionBy("slice").parquet(root)

    kind = StructType([docs.schema["doc_id"], StructField("ids", ArrayType(IntegerType()))])
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, blob, sizes = (batch.column(c)[i].as_py() for c in ("slice", "blob", "sizes"))
                table, places = _table(root, number, code), _unpacked(blob)
                counts = table.sizes[places]
                flat = gather(table.ids, table.starts[places], counts)
                offsets = np.concatenate([[0], np.cumsum(_sums(counts, sizes))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32)))
                ids = batch.column("doc_ids")[i].values.cast(schema.field("doc_id").type)
                yield pa.RecordBatch.from_arrays([ids, lists.cast(schema.field("ids").type)], schema=schema)

    return map_batches(marked.where(F.col("doc_ids").isNotNull()).select("slice", "blob", "doc_ids", "sizes"), run, kind)


class Decoder:
    """Texts of ids, by the bytes of each piece."""

    def __init__(self, path: str):
        self.model = model(path)
        tool, size = self.model.tool, len(self.model.pieces)
        self.control = np.array([tool.is_control(i) for i in range(size)], bool)
        self.marked = np.array([p.startswith(SPACE_MARK) for p in self.model.pieces], bool) & ~self.control
        surface = [self._surface(i) for i in range(size)]
        self.sizes = np.fromiter(map(len, surface), np.int64, size)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(surface), np.uint8)

    def _surface(self, i: int) -> bytes:
        tool, piece = self.model.tool, self.model.pieces[i]
        if tool.is_control(i):
            return b""
        if tool.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if tool.is_unknown(i):
            return tool.decode([i]).encode()
        return piece.replace(SPACE_MARK, b" ")

    def texts(self, ids: np.ndarray, sizes: list[int]) -> list[str]:
        """The texts of runs of ids. The mark before the first piece of a text is the model's own."""
        counts = self.sizes[ids]
        raw = gather(self.bytes, self.starts[ids], counts).tobytes()
        ends = np.cumsum(_sums(counts, sizes)) if sizes else np.empty(0, np.int64)
        out, at = [], 0
        for (a, b), size in zip(pairwise([0, *ends.tolist()]), sizes, strict=True):
            own = ids[at : at + size]
            at += size
            try:
                if self.control[own].any():
                    raise ValueError("controls part the bytes around them")
                out.append((raw[a + 1 : b] if size and self.marked[own[0]] else raw[a:b]).decode())
            except ValueError:
                # Controls, or byte pieces that make no text: the library has its own way of marking them.
                out.append(self.model.tool.decode(own.tolist()))
        return out


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    """One decoder per worker process, kept from task to task."""
    return Decoder(path)


def decode(rows: DataFrame, path: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """`rows` with the text of their ids in the column `out`, as the model's decode gives it.

    Missing ids give the empty text. Ids outside the model are an error. `out` takes the
    place of a column of that name.
    """
    kept = [f for f in rows.schema if f.name != out]
    kind = StructType([*kept, StructField(out, StringType())])
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = decoder(path)
        for batch in batches:
            lists = batch.column(column)
            sizes = [n or 0 for n in lists.value_lengths().to_pylist()]
            texts = tool.texts(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), sizes)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(texts, schema.field(out).type)], schema=schema
            )

    return map_batches(rows, run, kind)


def ids_digest(ids: np.ndarray, decimal: list[str]) -> str:
    """SHA-256 of the ids in decimal, joined by commas, a bounded number of them at a time."""
    held = sha256()
    for start in range(0, len(ids), DIGEST_IDS):
        part = ",".join(map(decimal.__getitem__, ids[start : start + DIGEST_IDS].tolist()))
        held.update((("," if start else "") + part).encode())
    return held.hexdigest()


def with_digests(rows: DataFrame, path: str) -> DataFrame:
    """`rows` with n_tokens, ids_sha256 and decoded_sha256 in the place of their ids.

    The digests are those of the ids in decimal, joined by commas, and of the text that
    `decode` gives for them.
    """
    kept = [f for f in rows.schema if f.name != "ids"]
    whole = StructType([*kept, *StructType.fromDDL("n_tokens bigint, ids_sha256 string, decoded_sha256 string")])
    schema = to_arrow_schema(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = decoder(path)
        decimal = [str(i) for i in range(len(tool.sizes))]
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = [n or 0 for n in lists.value_lengths().to_pylist()]
            ids = [ids_digest(flat[a:b], decimal) for a, b in pairwise(np.cumsum([0, *sizes]).tolist())]
            texts = [sha256(t.encode()).hexdigest() for t in tool.texts(flat.astype(np.int64), sizes)]
            columns = [*(batch.column(f.name) for f in kept), *map(pa.array, (sizes, ids, texts))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return map_batches(rows, run, whole)
