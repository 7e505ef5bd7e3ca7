import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import difference
from tests.conftest import SAMPLES
from tidemark.llm import negatives

FIELDS = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor, scale=256, low=80, high=100, top=5):
    """All anchors against all rows, in exact whole numbers."""
    kept = set()
    for i, v, y in rows:
        if None in (i, v, y) or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.add((i, tuple(math.floor(scale * float(np.float32(x))) for x in v), y))
    out = []
    for i, v, y in kept:
        if not anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in kept if j != i]
        for p, j in sorted((s, j) for s, j, z in scored if z == y)[:top]:
            fits = sorted((s, k) for s, k, z in scored if z != y and low * -p <= 100 * -s <= high * -p)[:top]
            out += [(i, j, rank, k, -p, -s) for rank, (s, k) in enumerate(fits, 1)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_query_equals_sql(spark, folder):
    problem, rows, _ = difference(spark, f"{SAMPLES}/{folder}", "op11_hard_negatives")
    assert problem is None and rows > 0


def clustered(seed, n=600, dims=6):
    rng = np.random.default_rng(seed)
    centres = 4 * rng.normal(size=(8, dims))
    x = centres[rng.integers(0, 8, n)] + 0.3 * rng.normal(size=(n, dims))
    return [(i, [float(c) for c in v], int(rng.integers(0, 4))) for i, v in enumerate(x)]


def test_deep_trees_with_equal_vectors_and_ties(spark, monkeypatch):
    """Leaves of a few rows, blocks of a few rows of them, and a third of all rows in one place."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 8)
    monkeypatch.setattr(negatives, "PART_BLOCKS", 2)
    monkeypatch.setattr(negatives.Tree.build, "__defaults__", (4, 6))
    rows = clustered(1)
    rows += [(1000 + i, [2.0] * 6, i % 3) for i in range(300)] + [(1000, [2.0] * 6, 0)] * 3
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, FIELDS).repartition(5)
    got = negatives.hard_negatives(df, F.col("vec_id") % 25 == 0, sample_rows=300)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert found(got) == brute(rows, lambda i: i % 25 == 0)


def test_ranges_leave_siblings_out_and_lose_no_row():
    rng = np.random.default_rng(3)
    x = np.floor(256 * np.array([v for _, v, _ in clustered(3, 2000)]))
    top = float(np.einsum("ij,ij->i", x, x).max())
    raised = negatives.lifted(x, top)
    tree = negatives.Tree.build(raised[:500], 6, 40)
    leaf = tree.leaves(raised)
    number = {id(n): i for i, n in enumerate(tree.nodes())}
    ranges = {}
    for row, own in zip(raised, leaf, strict=True):
        for node, child in tree.paths[own]:
            for point, d in enumerate(negatives.distances(row[None], node.points)[0]):
                low, high = ranges.get((number[id(node)], point, child), (np.inf, -np.inf))
                ranges[number[id(node)], point, child] = (min(low, d), max(high, d))
    tree.set_ranges([(*k, *v) for k, v in ranges.items()])
    at = rng.integers(0, len(x), 200)
    scores = x[at] @ x.T
    high = np.sort(scores, 1)[:, -3]
    low = np.ceil(0.9 * high)
    norm = np.einsum("ij,ij->i", x[at], x[at])
    inner, outer = (np.sqrt(np.maximum(norm + top - 2 * s, 0)) for s in (high, low))
    slack = negatives.Index(tree, None, {}, x.shape[1], top).slack
    visits = tree.visits(np.hstack([x[at], np.zeros((len(at), 1))]), inner, outer, slack)
    visited = np.zeros((len(at), len(tree.paths)), bool)
    for i, anchors in enumerate(visits):
        visited[anchors, i] = True
    inside = (scores >= low[:, None]) & (scores <= high[:, None])
    assert all(visited[a, leaf[inside[a]]].all() for a in range(len(at)))
    assert len(tree.paths) > 20 and visited.mean() < 0.5


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (100, [0.5, 0.5], 1), (200, [0.9, 0.1], None), (None, [1.0, 1.0], 2), (3, None, 2),
        (4, [1.0, None], 2), (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (7, [0.9], 2), (8, [0.9, 0.0, 3.0], 2), (9, [], 2),
        (10, [-1.0, 0.0], 1), (11, [0.0, 0.0], 1), (11, [0.0, 0.0], 1), (11, [0.1, 0.0], 2), (0, [1.0, 0.0], 1), (0, [0.7, 0.0], 2),
        (12, [0.0, 1.0], 2), (13, [0.85, 0.0], 3),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], FIELDS + ", score string, anchor_id int")
    anchors = F.col("vec_id") % 100 == 0
    assert found(negatives.hard_negatives(df, anchors)) == brute(rows, lambda i: i % 100 == 0)
    assert found(negatives.hard_negatives(df.limit(0), anchors)) == []
    assert found(negatives.hard_negatives(df, F.lit(False))) == []


@pytest.mark.parametrize("scale", [256, 1 << 20, 1 << 26])
def test_large_components_stay_exact(spark, scale):
    rows = clustered(5, 120, 3)
    got = negatives.hard_negatives(spark.createDataFrame(rows, FIELDS), F.col("vec_id") % 10 == 0, scale=scale)
    assert found(got) == brute(rows, lambda i: i % 10 == 0, scale)


def test_scores_beyond_64_bits_are_refused(spark):
    df = spark.createDataFrame([(i, [1e30, 1.0], i % 2) for i in range(4)], FIELDS)
    with pytest.raises(Exception, match="64 bits"):
        negatives.hard_negatives(df, F.lit(True)).collect()
