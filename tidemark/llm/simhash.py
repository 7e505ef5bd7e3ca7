"""SimHash fingerprints, and near copies through a grid over segment bit counts.

A fingerprint's 64 bits are cut into 32 segments of two bits; the bit counts of the
segments (0, 1 or 2 each) are a point in a 32-dimensional grid. One differing bit
moves the point by at most one step, so the Manhattan distance of two points is a
lower bound of the Hamming distance of their fingerprints. A range join on the grid
proposes links, and the fingerprints themselves decide.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_slices, raw_texts
from tidemark.llm.components import component_roots
from tidemark.llm.rows import free_names, keep_places, placed, write_places
from tidemark.storage import fresh_path, materialize, scratch

SEED = 42
#: Low bit of each two-bit segment.
LOW_BITS = 0x5555555555555555
SEGMENTS = 32
#: Above so many fingerprints a cell links through exact midpoints instead of pairs.
PAIR_CELL = 64


def shingle_hashes(text: bytes, shingle_words: int) -> np.ndarray:
    """XXH64 of each run of `shingle_words` words, repeats included.

    A-Z are lower-cased and words are split at ASCII white space. Fewer words give
    one shingle of all of them, no words give none.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle_words + 1]
    cuts = map(slice, starts.tolist(), ends[shingle_words - 1 :].tolist())
    return np.fromiter(
        map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED)), np.uint64, len(starts)
    )


def majority_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """One fingerprint per array: the bits set in over half of its hashes; zero for none."""
    out = np.zeros(len(hashes), np.uint64)
    sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return out
    flat = np.concatenate([hashes[i] for i in filled]).astype("<u8")
    bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    starts = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
    counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    major = (2 * counts > sizes[filled][:, None]).astype(np.uint8)
    out[filled] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle_words: int = 3, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (doc_id) with fp, the fingerprint as a signed long, of every row of `docs`.

    A missing or empty text, or one of white space only, has fingerprint zero.
    """
    keep = keep or ["doc_id"]

    def make():
        def work(piece: pa.RecordBatch):
            prints = majority_bits([shingle_hashes(t, shingle_words) for t in raw_texts(piece)])
            return {c: piece.column(c) for c in keep} | {"fp": prints.view(np.int64)}

        return work

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_slices(docs.select(*keep, "text"), f"{kinds}, fp long", make, limit=1 << 20)


def hex_digits(fp: Column) -> Column:
    """16 lowercase hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def grid_point(fp: Column) -> Column:
    """The 32 segment bit counts, two bits each, packed in a long."""
    odd = fp.bitwiseAND(F.lit(LOW_BITS))
    even = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW_BITS))
    return odd.bitwiseXOR(even).bitwiseOR(F.shiftleft(odd.bitwiseAND(even), 1))


def _steps(cell: Column, segment: Column) -> Column:
    """The points one step from `cell` along a segment; null where the grid ends."""
    shift = (segment * 2).cast("int")
    one, three = F.call_function("shiftleft", F.lit(1).cast("long"), shift), F.call_function(
        "shiftleft", F.lit(3).cast("long"), shift
    )
    count = F.call_function("shiftrightunsigned", cell, shift).bitwiseAND(F.lit(3).cast("long"))
    return F.array(
        F.when(count <= 1, cell.bitwiseXOR(one)), F.when(count >= 1, cell.bitwiseXOR(three))
    )


def _around(point: Column, radius: int) -> Column:
    """All grid points within `radius` steps of `point`, itself included."""
    cells = F.array(point)
    for _ in range(radius):
        moved = F.transform(
            cells,
            lambda c: F.flatten(F.transform(F.sequence(F.lit(0), F.lit(SEGMENTS - 1)), lambda s: _steps(c, s))),
        )
        cells = F.array_distinct(F.concat(cells, F.array_compact(F.flatten(moved))))
    return cells


def _flipped(fp: Column, radius: int) -> Column:
    """All fingerprints within `radius` bits of `fp`, itself included."""
    prints = F.array(fp)
    for _ in range(radius):
        moved = F.transform(
            prints,
            lambda p: F.transform(
                F.sequence(F.lit(0), F.lit(63)),
                lambda b: p.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)),
            ),
        )
        prints = F.array_distinct(F.concat(prints, F.flatten(moved)))
    return prints


def links(distinct: DataFrame, max_bits: int = 2, pair_cell: int = PAIR_CELL) -> DataFrame:
    """Links (u, v) that join all fingerprints at `max_bits` or fewer differing bits.

    `distinct` has one row per fingerprint `fp`. Two points within `max_bits` steps
    share a cell within half as many steps of both, so each fingerprint enters the
    cells of that radius and those of a common cell are candidates. A cell of up to
    `pair_cell` fingerprints compares its pairs; every pair within the distance is a
    link. A fuller cell would need a square number of comparisons. There each
    fingerprint names the exact fingerprints in the cell that are within half the
    distance of it, and all that name the same one join its smallest: they are within
    the distance of each other. Links come out connected alike either way. An odd
    `max_bits` has no exact midpoints and is refused.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    radius = max_bits // 2
    # A fingerprint enters dozens of cells: small rows, so their number decides the tasks. They are
    # written, as Spark's estimate of their size leaves out how they multiply, and it would broadcast them.
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = distinct.select("fp").repartition(tasks, "fp")
    cells = materialize(spread.select("fp", F.explode(_around(grid_point(F.col("fp")), radius)).alias("cell")), "cells")
    shared = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    busy = materialize(cells.join(shared, "cell"), "busy-cells")
    few = busy.where(F.col("n") <= pair_cell)
    pairs = (
        few.alias("a")
        .join(few.alias("b"), "cell")
        .where("a.fp < b.fp")
        .where(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits)
        .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
    )
    full = busy.where(F.col("n") > pair_cell)
    named = full.select("fp", "cell", F.explode(_flipped(F.col("fp"), radius)).alias("mid")).where(
        grid_point(F.col("mid")) == F.col("cell")
    )
    centre = named.groupBy("mid").agg(F.min("fp").alias("v"))
    stars = named.join(centre, "mid").where("fp <> v").select(F.col("fp").alias("u"), "v")
    return pairs.unionByName(stars)


def _components(docs: DataFrame, shingle_words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, component_id) of every fingerprint."""
    prints = materialize(fingerprints(docs, shingle_words), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = component_roots(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints, rooted.join(names, "root").select("fp", "component_id")


def near_copies(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) of every row of `docs`.

    Rows with fingerprints at `max_bits` or fewer differing bits are linked; a
    component is what links reach, named by its smallest doc_id. Copies share one
    fingerprint and are linked once. Rows without words have fingerprint zero and are
    linked like any other. A missing doc_id keeps its row and names no component: its
    component_id is null only if no id is reachable. Repeated rows come out as often as
    they go in; other columns are ignored; an empty table gives an empty one.
    """
    prints, named = _components(docs, shingle_words, max_bits)
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of `docs` of each component (see `near_copies`), all columns kept.

    It is the row with the smallest doc_id; of rows with the same id, and in a component
    without any id, the first by file and place in the file. So repeated and missing ids
    need no care of their own. Missing, empty and blank texts are copies of one another.
    An empty table gives an empty one; columns may have any names.

    Only ids, fingerprints and places are shuffled. The texts are read a second time,
    and each task keeps the rows listed for its files.
    """
    spark, names = docs.sparkSession, free_names(docs, "near_file", "near_row")
    numbered = placed(docs, names)
    kept = fresh_path(spark, "kept-rows")
    with scratch(spark, "near-copies"):
        prints = materialize(fingerprints(numbered, shingle_words, ["doc_id", *names]), "fingerprints").select(
            "doc_id", F.col(names[0]).alias("file"), F.col(names[1]).alias("row"), "fp"
        )
        first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "row"))
        distinct = materialize(prints.groupBy("fp").agg(first.alias("first")), "distinct")
        roots = component_roots(links(distinct.select("fp"), max_bits))
        rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        stay = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
        write_places(stay.select("first.file", "first.row"), kept)
    return keep_places(numbered, names, kept)
