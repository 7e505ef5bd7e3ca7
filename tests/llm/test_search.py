import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from checks.compare import difference
from tests.conftest import SAMPLES
from tidemark.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs: list[tuple], items: list[tuple], top: int = 10) -> dict:
    """{item: [(score, doc), ...]} with all documents scored for all items."""
    words = [terms(t) for _, t in docs]
    n_docs, total = sum(map(bool, words)), sum(map(len, words))
    counts = [Counter(w) for w in words]
    df = Counter(t for c in counts for t in c)
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = {}
    for item, own in asked.items():
        found = []
        for (doc, _), w, c in zip(docs, words, counts, strict=True):
            m = 10 + (90 * len(w) * n_docs // total if total else 0)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in own if t in c
            )
            if score > 0:
                found.append((score, doc))
        found.sort(key=lambda f: (-f[0], f[1] is None, f[1]))
        if found:
            out[item] = found[:top]
    return out


def collected(df):
    out: dict = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["item_id"], []).append((r["score"], r["doc_id"]))
        assert r["rank"] == len(out[r["item_id"]])
    return out


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, folder):
    problem, rows, _ = difference(spark, f"{SAMPLES}/{folder}", "op13_ranked_search")
    assert problem is None and rows > 0


@pytest.mark.parametrize("shard,stride,share", [(10, 4, 0.0), (37, 8, 0.2), (500, 64, 1.0)])
def test_lists_short_and_long_equal_brute_force(spark, monkeypatch, shard, stride, share):
    """Shards of a few documents, short strides, none to all lists summed first, one query a block."""
    rng = random.Random(shard)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "日本", "X9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 30)))) for i in range(300)]
    docs += [(300 + i, docs[i % 7][1]) for i in range(60)]
    rng.shuffle(docs)
    items = [(f"q{i}", " ".join(rng.choices(vocabulary, k=rng.randrange(1, 9)))) for i in range(25)]
    monkeypatch.setattr(search, "BLOCK_TERMS", 1)
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    wanted = brute(docs, items)

    # Tasks run in other processes, so their parts are run here.
    monkeypatch.setattr(search, "SHARD_DOCS", shard)
    monkeypatch.setattr(search, "STRIDE", stride)
    monkeypatch.setattr(search, "SHORT_SHARE", share)
    monkeypatch.setattr(search, "SHORT_LIST", 0)
    words = [terms(t) for _, t in docs]
    n_docs, total = sum(map(bool, words)), sum(map(len, words))
    df = Counter(t for w in words for t in set(w))
    for item, text in items:
        best = search.Best(10)
        for a in range(0, len(docs), shard):
            own = [Counter(w) for w in words[a : a + shard]]
            m = search.damping(np.array([len(w) for w in words[a : a + shard]]), n_docs, total)
            lists = []
            for t in set(terms(text)):
                at = [i for i, c in enumerate(own) if t in c]
                if at:
                    tfs = np.array([own[i][t] for i in at])
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    lists.append((w, search.Postings(np.array(at), tfs, int(tfs.max()), int(m[at].min()))))
            search.rank_shard(lists, m, [i for i, _ in docs[a : a + shard]], best)
        best.found.sort(key=lambda f: (-f[0], f[1]))
        assert best.found == wanted[item]
    assert collected(search.search(frame, spark.createDataFrame(items, "item_id string, text string"))) == wanted


def test_lists_set_aside_are_only_probed():
    """A common term's list is not walked once ten better documents are known."""
    m = np.full(5000, 10)
    common = search.Postings(np.arange(5000), np.ones(5000, int), 1, 10)
    rare = search.Postings(np.arange(0, 5000, 100), np.ones(50, int), 1, 10)
    touched = []

    class Watched(search.Postings):
        def part(self, at, m):
            touched.append(len(self.docs[at]))
            return super().part(at, m)

    best = search.Best(10)
    search.rank_shard([(1, Watched(**vars(common))), (1000, rare)], m, list(range(5000)), best)
    assert sorted(d for _, d in best.found) == list(range(0, 1000, 100))
    # The first stride is walked; later only the rare term's documents are looked up.
    assert sum(touched) <= search.STRIDE + 50


def test_odd_rows(spark, odd_docs, make_docs):
    docs = odd_docs.unionByName(make_docs([(None, "no id either 12", "en"), (7, "Same, same; TEXT", None)]))
    items = [("a", "the same text"), ("a", "the same text"), (None, "12 no id"), ("b", None), ("c", ""), ("d", "absentword"), ("e", "word")]
    queries = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id string, text string, rank int, score string")
    got = collected(search.search(docs, queries))
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert set(got) == {"a", None, "e"}
    assert search.search(make_docs([]), queries).count() == 0
    assert search.search(docs, queries.limit(0)).count() == 0
    assert search.search(docs, queries).columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_go_to_the_smallest_ids(spark):
    docs = [(i, "one common text") for i in range(400, 0, -1)] + [(500 + i, f"other words {i}") for i in range(900)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    items = spark.createDataFrame([(1, "common text")], "item_id int, text string")
    assert [d for _, d in collected(search.search(frame, items))[1]] == list(range(1, 11))
