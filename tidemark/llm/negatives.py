"""Hard negatives by a multiway hyperplane tree with ranges between siblings.

A node of the tree has several split points and a child for each; a row goes to the child
whose point is nearest. For every split point and every sibling subtree the tree stores the
least and the largest distance of the subtree's rows from the point, over all rows. A search
for scores in a window is one for distances in an annulus around the anchor. By the
triangle inequality a point's distance to the anchor turns the annulus into a range of
distances from that point, and siblings whose stored range does not meet it are left out.
The leaves that remain are scored exactly.

Rows are lifted to one sphere by one more coordinate, zero for anchors, so that distances
and inner products order rows alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import map_batches
from tidemark.storage import materialize

#: Rows of the sample the split points come from; the tree and its ranges are bounded by it.
SAMPLE_ROWS = 8192
#: Split points of a node, and sampled rows a leaf may hold.
FAN_OUT, LEAF_SAMPLE = 8, 256
MAX_DEPTH = 12
#: Rows scored together, windows they are scored for at a time, and blocks a pack of these meets at once.
BLOCK_ROWS, PACK_WINDOWS, PART_BLOCKS = 4096, 256, 16
#: Whole numbers below are exact in floats and doubles.
EXACT_FLOAT, EXACT_DOUBLE = 1 << 24, 1 << 53

ROW = "vec_id bigint, label bigint, vec binary, dims int, norm double"


def clean(rows: DataFrame, scale: int, label: Column) -> DataFrame:
    """(vec_id, label, vec, dims, norm) of the rows that take part.

    Components are floor(scale * x), as floats where these hold them, else doubles; `norm` is
    the squared length. Rows without an id, a label or a vector, or with a component that is
    missing or not finite, take no part.
    """
    kind = StructType.fromDDL(ROW)
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec_id, own, lists = batch.columns
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
            ends = np.cumsum(sizes)
            starts = ends - sizes
            odd = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            whole = pc.and_(pc.and_(vec_id.is_valid(), own.is_valid()), lists.is_valid())
            good = whole.to_numpy(zero_copy_only=False) & (odd[ends] == odd[starts])
            for n in np.unique(sizes[good]).tolist():
                at = np.flatnonzero(good & (sizes == n))
                x = np.floor(scale * flat[starts[at][:, None] + np.arange(n)])
                if not np.isfinite(x).all():
                    raise OverflowError("a component is too large for whole numbers")
                small = np.abs(x).max(1, initial=0) < EXACT_FLOAT
                raw = [(r.astype("<f4") if f else r).tobytes() for r, f in zip(x, small.tolist(), strict=True)]
                take = pa.array(at)
                columns = [vec_id.take(take), own.take(take), raw, [n] * len(at), np.einsum("ij,ij->i", x, x)]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                )

    taken = rows.select(
        F.col("vec_id").cast("bigint"), label.cast("bigint").alias("label"), F.col("embedding").cast("array<double>")
    )
    return map_batches(taken, run, kind)


def vectors(vecs: list[bytes], dims: list[int], width: int) -> np.ndarray:
    """Rows of doubles, shorter ones filled up with zeros."""
    out = np.zeros((len(vecs), width))
    for i, (raw, n) in enumerate(zip(vecs, dims, strict=True)):
        out[i, :n] = np.frombuffer(raw, "<f8" if len(raw) == 8 * n else "<f4")
    return out


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Rows with one more coordinate that gives all of them the squared length `top`."""
    rest = np.sqrt(np.maximum(top - np.einsum("ij,ij->i", x, x), 0.0))
    return np.hstack([x, rest[:, None]])


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row from each point."""
    square = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", points, points) - 2 * (x @ points.T)
    return np.sqrt(np.maximum(square, 0.0))


@dataclass
class Node:
    """Split points with a child each: another node, or the number of a leaf."""

    points: np.ndarray
    children: list[Node | int] = field(default_factory=list)
    #: Least and largest distance from point i to the rows below child j.
    low: np.ndarray | None = None
    high: np.ndarray | None = None


@dataclass
class Tree:
    """The node at the top, if there is more than one leaf, and the leaves' paths of (node, child)."""

    root: Node | int
    paths: list[list[tuple[Node, int]]]

    @staticmethod
    def build(sample: np.ndarray, fan_out: int = FAN_OUT, leaf: int = LEAF_SAMPLE) -> Tree:
        """A tree over a sample: split points are sampled rows far from one another."""
        paths: list[list[tuple[Node, int]]] = []

        def grow(rows: np.ndarray, path: list[tuple[Node, int]]) -> Node | int:
            if len(rows) > leaf and len(path) < MAX_DEPTH:
                points = far_points(rows, fan_out)
                if len(points) > 1:
                    node = Node(points)
                    nearest = distances(rows, points).argmin(1)
                    for i in range(len(points)):
                        node.children.append(grow(rows[nearest == i], [*path, (node, i)]))
                    return node
            paths.append(path)
            return len(paths) - 1

        return Tree(grow(sample, []), paths)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row; of equally near points the first counts."""
        out = np.zeros(len(x), np.int64)

        def go(node: Node | int, at: np.ndarray) -> None:
            if isinstance(node, int):
                out[at] = node
            elif len(at):
                nearest = distances(x[at], node.points).argmin(1)
                for i, child in enumerate(node.children):
                    go(child, at[nearest == i])

        go(self.root, np.arange(len(x)))
        return out

    def nodes(self) -> list[Node]:
        return list({id(n): n for p in self.paths for n, _ in p}.values())

    def set_ranges(self, found: list[tuple[int, int, int, float, float]]) -> None:
        """Take in (node, point, child, least, largest); subtrees without rows keep an empty range."""
        nodes = self.nodes()
        for n in nodes:
            n.low = np.full((len(n.points), len(n.points)), math.inf)
            n.high = np.full((len(n.points), len(n.points)), -math.inf)
        for node, point, child, low, high in found:
            nodes[node].low[point, child], nodes[node].high[point, child] = low, high

    def visits(self, anchors: np.ndarray, inner: np.ndarray, outer: np.ndarray, slack: float) -> list[np.ndarray]:
        """For each leaf the anchors whose annuli, of radii `inner` to `outer`, may hold rows there."""
        out = [np.empty(0, np.int64)] * len(self.paths)

        def go(node: Node | int, at: np.ndarray) -> None:
            if isinstance(node, int):
                out[node] = at
                return
            d = distances(anchors[at], node.points)
            near, far = inner[at][:, None], outer[at][:, None]
            # Distances from each point at which rows of the annulus can be.
            least = np.maximum(d - far, near - d) - slack
            most = d + far + slack
            # An annulus reaches a subtree if it meets its range from every split point.
            meets = ((least[:, :, None] <= node.high) & (most[:, :, None] >= node.low)).all(1)
            for i, child in enumerate(node.children):
                kept = at[meets[:, i]]
                if len(kept):
                    go(child, kept)

        if len(anchors):
            go(self.root, np.arange(len(anchors)))
        return out


def far_points(rows: np.ndarray, count: int) -> np.ndarray:
    """Up to `count` different rows, each the farthest from those before it."""
    chosen = [0]
    near = distances(rows, rows[:1])[:, 0]
    while len(chosen) < count:
        far = int(near.argmax())
        if near[far] <= 1e-6 * (1 + np.abs(rows).max()):
            break
        chosen.append(far)
        near = np.minimum(near, distances(rows, rows[far : far + 1])[:, 0])
    return rows[chosen]


@dataclass(frozen=True)
class Index:
    """The tree, and the rows of each leaf in blocks."""

    tree: Tree
    blocks: DataFrame
    #: Blocks of each leaf.
    counts: dict[int, int]
    width: int
    #: The largest squared length.
    top: float

    @property
    def slack(self) -> float:
        """Bound of the error of computed distances: that of near points, whose squares cancel."""
        return math.sqrt(16 * np.finfo(float).eps * (self.width + 16) * (self.top + 1))


def build_index(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Index:
    """Index all of `rows` (see `clean`; written); split points come from about `sample_rows` of them.

    Only the tree, a range for each pair of siblings and the leaves' sizes are at the driver.
    """
    spark = rows.sparkSession
    count, width, top = rows.agg(F.count("*"), F.max("dims"), F.max("norm")).first()
    width, top = width or 0, top or 0.0
    if top >= 1 << 62:
        raise OverflowError("scores may not fit 64 bits")
    share = min(1.0, sample_rows / count) if count else 1.0
    low = F.pmod(F.xxhash64("vec_id", "vec"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)
    picked = rows.where(low).select("vec_id", "vec", "dims").distinct().limit(2 * sample_rows).collect()
    sample = sorted(picked, key=lambda r: (r["vec_id"], r["vec"]))
    tree = Tree.build(lifted(vectors([r["vec"] for r in sample], [r["dims"] for r in sample], width), top))
    held = spark.sparkContext.broadcast(tree)
    kind = StructType.fromDDL("leaf int, slot bigint, " + ROW)
    schema = to_arrow_schema(kind)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = 0
        for batch in batches:
            x = lifted(vectors(batch.column("vec").to_pylist(), batch.column("dims").to_pylist(), width), top)
            leaf, slots = pa.array(held.value.leaves(x).astype(np.int32)), pa.array(np.arange(slot, slot + len(x)))
            slot += len(x)
            yield pa.RecordBatch.from_arrays([leaf, slots, *batch.columns], schema=schema)

    placed = materialize(map_batches(rows, assign, kind), "leaf-rows")
    tree.set_ranges(_ranges(placed, held, width, top))
    sizes = placed.groupBy("leaf").count().collect()
    counts = {r["leaf"]: -(-r["count"] // BLOCK_ROWS) for r in sizes}
    return Index(tree, materialize(_blocks(placed, counts, width, top), "leaf-blocks"), counts, width, top)


def _ranges(placed: DataFrame, held, width: int, top: float) -> list[tuple[int, int, int, float, float]]:
    """Least and largest distance between each split point and each sibling subtree, over all rows."""
    kind = StructType.fromDDL("node int, point int, child int, low double, high double")
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = held.value
        number = {id(n): i for i, n in enumerate(tree.nodes())}
        found: dict[tuple[int, int, int], tuple[float, float]] = {}
        for batch in batches:
            x = lifted(vectors(batch.column("vec").to_pylist(), batch.column("dims").to_pylist(), width), top)
            leaf = batch.column("leaf").to_numpy(zero_copy_only=False)
            for own in np.unique(leaf):
                part = x[leaf == own]
                for node, child in tree.paths[own]:
                    d = distances(part, node.points)
                    for point, (a, b) in enumerate(zip(d.min(0).tolist(), d.max(0).tolist(), strict=True)):
                        key = (number[id(node)], point, child)
                        low, high = found.get(key, (math.inf, -math.inf))
                        found[key] = (min(low, a), max(high, b))
        yield _batch(schema, [(*k, *v) for k, v in found.items()])

    ranges = map_batches(placed.select("leaf", "vec", "dims"), run, kind)
    merged = ranges.groupBy("node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return [tuple(r) for r in merged.collect()]


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _blocks(placed: DataFrame, counts: dict[int, int], width: int, top: float) -> DataFrame:
    """(leaf, part, ids, labels, keys, vecs): a leaf's rows in matrices of about BLOCK_ROWS.

    Rows are dealt to a leaf's blocks by a hash of their place, so that a leaf of many equal vectors
    spreads like any other. A `part` is the number of PART_BLOCKS blocks of the leaf.
    """
    shares = placed.sparkSession.createDataFrame(list(counts.items()), "leaf int, blocks int")
    dealt = placed.join(F.broadcast(shares), "leaf").select(
        "leaf", F.pmod(F.xxhash64("slot", "vec_id"), F.col("blocks")).cast("int").alias("block"),
        "vec_id", "label", F.xxhash64("vec_id", "label", "vec").alias("row_key"), "vec", "dims",
    )
    number = "<f4" if top < EXACT_FLOAT else "<f8"
    kind = StructType.fromDDL("leaf int, part int, ids binary, labels binary, keys binary, vecs binary")
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            ids, labels, keys = (table[c].to_numpy().astype("<i8").tobytes() for c in ("vec_id", "label", "row_key"))
            x = vectors(table["vec"].to_pylist(), table["dims"].to_pylist(), width).astype(number)
            return _batch(schema, [(now[0], now[1] // PART_BLOCKS, ids, labels, keys, x.tobytes())])

        for batch in batches:
            leaf, number_of = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "block"))
            cuts = np.flatnonzero((np.diff(leaf) != 0) | (np.diff(number_of) != 0)) + 1
            for a, b in pairwise([0, *cuts.tolist(), len(leaf)]):
                if a == b:
                    continue
                key = int(leaf[a]), int(number_of[a])
                if held and key != now:
                    yield block()
                    held = []
                now = key
                held.append(batch.slice(a, b - a))
        if held:
            yield block()

    return map_batches(dealt.repartition("leaf", "block").sortWithinPartitions("leaf", "block"), run, kind)


def scores(anchors: np.ndarray, rows: np.ndarray, top: float) -> np.ndarray:
    """Inner products as whole numbers. No partial sum passes `top`, the largest squared length."""
    if top < EXACT_DOUBLE:
        kind = np.float32 if top < EXACT_FLOAT else np.float64
        return (anchors.astype(kind) @ rows.astype(kind).T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return (exact(anchors) @ exact(rows).T).astype(np.int64)


#: A search: rows of the anchor's own label (`same`) or of others, with scores from `low` to `high`.
WINDOW = (
    "anchor bigint, anchor_key bigint, label bigint, vec binary, dims int, norm double, place int, "
    "low bigint, high bigint, same boolean"
)
FOUND = "anchor bigint, anchor_key bigint, place int, row_id bigint, score bigint, row_key bigint"


def best_in_windows(index: Index, windows: DataFrame, top: int, home: bool = False) -> DataFrame:
    """(anchor, anchor_key, place, row_id, score, row_key, rank): each window's `top` rows.

    Higher scores come first, then smaller ids. Rows with the anchor's id do not count; rows that
    agree in id, label and vector count once. With `home` only the anchor's own leaf is searched.
    """
    held = windows.sparkSession.sparkContext.broadcast((index.tree, index.counts, index.width, index.top, index.slack))
    kind = StructType.fromDDL("leaf int, part int, pack binary")
    schema = to_arrow_schema(kind)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The leaves that each window visits, and windows in packs for each part of them."""
        tree, counts, width, largest, slack = held.value
        for batch in batches:
            x = vectors(batch.column("vec").to_pylist(), batch.column("dims").to_pylist(), width)
            norm, low, high = (
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("norm", "low", "high")
            )
            if home:
                leaf = tree.leaves(lifted(x, largest))
                visits = [np.flatnonzero(leaf == i) for i in range(len(tree.paths))]
            else:
                inner, outer = (np.sqrt(np.maximum(norm + largest - 2 * s, 0.0)) for s in (high, low))
                visits = tree.visits(np.hstack([x, np.zeros((len(x), 1))]), inner, outer, slack)
            for leaf, found in enumerate(visits):
                found = found[low[found] <= high[found]]
                parts = -(-counts.get(leaf, 0) // PART_BLOCKS)
                for start in range(0, len(found) if parts else 0, PACK_WINDOWS):
                    pack = pa.Table.from_batches([batch]).take(pa.array(found[start : start + PACK_WINDOWS]))
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, pack.schema) as writer:
                        writer.write_table(pack)
                    raw = sink.getvalue().to_pybytes()
                    for part in range(parts):
                        yield _batch(schema, [(leaf, part, raw)])

    found_kind = StructType.fromDDL(FOUND)
    found_schema = to_arrow_schema(found_kind)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, width, largest, _ = held.value
        for batch in batches:
            for row in batch.to_pylist():
                yield _batch(found_schema, score_pack(row, width, largest, top))

    packs = map_batches(windows.select(*StructType.fromDDL(WINDOW).names), route, kind)
    met = index.blocks.join(packs, ["leaf", "part"])
    found = map_batches(met, score, found_kind).repartition("anchor", "anchor_key", "place").dropDuplicates()
    order = Window.partitionBy("anchor", "anchor_key", "place").orderBy(F.desc("score"), "row_id", "row_key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def score_pack(met: dict, width: int, largest: float, top: int) -> list[tuple]:
    """The `top` rows of a block for each window of a pack."""
    ids, labels, keys = (np.frombuffer(met[c], "<i8") for c in ("ids", "labels", "keys"))
    _, first = np.unique(np.stack([ids, keys], 1), axis=0, return_index=True)
    x = np.frombuffer(met["vecs"], "<f4" if largest < EXACT_FLOAT else "<f8").reshape(-1, width)[first]
    ids, labels, keys = ids[first], labels[first], keys[first]
    windows = pa.ipc.open_stream(met["pack"]).read_all().to_pylist()
    found = scores(vectors([w["vec"] for w in windows], [w["dims"] for w in windows], width), x, largest)
    out = []
    for w, own in zip(windows, found, strict=True):
        fits = (own >= w["low"]) & (own <= w["high"]) & ((labels == w["label"]) == w["same"]) & (ids != w["anchor"])
        at = np.flatnonzero(fits)
        if len(at) > top:
            at = at[own[at] >= np.partition(own[at], len(at) - top)[len(at) - top]]
        at = at[np.lexsort((ids[at], -own[at]))][:top]
        out += [
            (w["anchor"], w["anchor_key"], w["place"], i, s, k)
            for i, s, k in zip(ids[at].tolist(), own[at].tolist(), keys[at].tolist(), strict=True)
        ]
    return out


def _share(score: Column, percent: int, up: bool) -> Column:
    """score * percent / 100, rounded down or up to whole numbers, without large products."""
    rest = F.pmod(score, F.lit(100))
    whole = F.call_function("div", score - rest, F.lit(100)) * percent
    return whole + F.call_function("div", rest * percent + (99 if up else 0), F.lit(100))


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    label: Column | None = None,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `rows` has vec_id, embedding and label; vectors become floor(scale * x) and scores are their inner
    products. `anchors` picks the anchors by vec_id. An anchor's positives are the other rows of its
    label with the highest scores; for each of these, its negatives are the rows of other labels with
    the highest scores from `low` to `high` percent of the positive's. Ties go to smaller ids, and all are
    found exactly.

    Rows without an id, a label or a vector, or with a missing or not finite component, take no
    part. Rows that repeat id, label and vector count once; rows of one id are never each other's
    positives or negatives. Shorter vectors count as filled up with zeros. Other columns are ignored; an
    empty table gives an empty one. Vectors whose scores may pass 64 bits are an error.
    """
    taken = materialize(clean(rows, scale, F.col("label") if label is None else label), "vectors")
    index = build_index(taken, sample_rows)
    chosen = taken.where(anchors).distinct().select(
        F.col("vec_id").alias("anchor"), F.xxhash64("vec_id", "label", "vec").alias("anchor_key"), "label", "vec", "dims", "norm"
    )
    chosen = materialize(chosen, "anchors")
    key = ["anchor", "anchor_key"]
    most = math.ceil(index.top) + 1
    whole = chosen.select("*", F.lit(0).alias("place"), F.lit(-most).alias("low"), F.lit(most).alias("high"), F.lit(True).alias("same"))
    # The anchor's own leaf gives a score that the last of its positives reaches at least.
    near = best_in_windows(index, whole, positives, home=True)
    reached = near.where(F.col("rank") == positives).select(*key, F.col("score").alias("reached"))
    bounded = whole.join(reached, key, "left").withColumn("low", F.coalesce("reached", "low"))
    found = materialize(best_in_windows(index, bounded, positives), "positives")
    found = found.select(
        *key, F.col("rank").alias("place"), F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    score = F.col("positive_score")
    below = chosen.join(found, key).select(
        "*", _share(score, low, True).alias("low"), _share(score, high, False).alias("high"), F.lit(False).alias("same")
    )
    hard = best_in_windows(index, below, negatives).join(found, [*key, "place"])
    return hard.select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int"),
        F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
