import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.components import component_roots


def brute_print(text: str, k: int = 3) -> int:
    words = [w for w in text.encode().lower().split() if w]
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_components(prints: list[int], ids: list[int], bits: int = 2) -> list[int]:
    label = dict(enumerate(ids))
    near = [
        (i, j)
        for i in range(len(prints))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= bits
    ]
    while True:
        before = dict(label)
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
        if label == before:
            return [label[i] for i in range(len(prints))]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_match_their_definition(spark, make_docs, odd_docs):
    texts = {1: "a B  c\td e", 2: "One", 3: "ÀB c d ÀB c d", 4: " ".join(map(str, range(500)))}
    docs = make_docs([(i, t, "en") for i, t in texts.items()])
    got = {r["doc_id"]: r["fp"] for r in simhash.fingerprints(docs).collect()}
    assert got == {i: signed(brute_print(t)) for i, t in texts.items()}
    native = spark.sql("select xxhash64('a b c') h").first()["h"]
    assert native == signed(xxhash.xxh64_intdigest(b"a b c", 42))


@pytest.mark.parametrize("pair_cell", [1, 64])
def test_links_are_those_of_brute_force(spark, pair_cell):
    rng = random.Random(5)
    prints = []
    for _ in range(12):
        base = rng.getrandbits(64)
        prints.append(base)
        for _ in range(12):
            base ^= 1 << rng.randrange(64) if rng.random() < 0.7 else (1 << rng.randrange(64)) | 1
            prints.append(base)
    prints = list(dict.fromkeys(prints))
    # All neighbours of one fingerprint: a crowd that shares cells.
    crowd = [0x0F0F << 20 ^ 1 << b for b in range(40)]
    prints += [p for p in crowd if p not in prints]
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    roots = {r["node"]: r["root"] for r in component_roots(simhash.links(df, 2, pair_cell)).collect()}
    got = [roots.get(signed(p), signed(p)) for p in prints]
    want = brute_components(prints, list(range(len(prints))))
    assert [[a == b for b in got] for a in got] == [[a == b for b in want] for a in want]


def test_grid_distance_is_a_lower_bound(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(-(2**63), 2**63 - 1, 300)
    rows = spark.createDataFrame([(int(x),) for x in a], "fp long")
    found = {r["fp"]: r["p"] for r in rows.select("fp", simhash.grid_point(F.col("fp")).alias("p")).collect()}
    for fp, point in found.items():
        want = [((fp >> 2 * s) & 3).bit_count() for s in range(32)]
        assert [(point >> 2 * s) & 3 for s in range(32)] == want


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(7, 7), (9, 8)], "u long, v long")
    got = {r["node"]: r["root"] for r in component_roots(edges).collect()}
    assert got == dict.fromkeys(range(1, 301), 0)


def test_odd_rows(odd_docs, make_docs):
    rows = simhash.near_copies(odd_docs).collect()
    assert len(rows) == 8
    empty = {r["doc_id"]: (r["fp"], r["component_id"]) for r in rows if r["fp"] == 0}
    assert empty == {1: (0, 1), 2: (0, 1), 3: (0, 1)}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    kept = simhash.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 5, 6]
    none = make_docs([])
    assert simhash.near_copies(none).count() == simhash.drop_near_copies(none).count() == 0


def test_one_row_of_each_component_stays(make_docs):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcde")
    rows = [(7, a), (7, b), (3, c), (3, d), (2, d), (4, c), (None, c), (None, e), (None, e), (8, a), (2, d)]
    kept = simhash.drop_near_copies(make_docs([(i, t, "en") for i, t in rows])).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(7, a), (7, b), (3, c), (2, d), (0, e)])


def test_an_odd_distance_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_rows_are_told_by_their_place(spark, make_docs, tmp_path):
    """Clashing names, repeated and missing ids, several files, and scans cut anew."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(7, a), (7, b), (3, c), (3, c), (None, c), (None, a), (None, "z"), (None, "z"), (1, ""), (2, None)]
    docs = make_docs([(i, t, "en") for i, t in rows]).withColumn("near_file", F.lit("x")).withColumn("_near_row", F.lit(1))
    path = str(tmp_path / "docs")
    docs.repartition(3).write.parquet(path)
    want = sorted([(7, a), (7, b), (3, c), (0, "z"), (1, "")])
    for df in (docs, spark.read.parquet(path)):
        kept = simhash.drop_near_copies(df)
        assert kept.columns == docs.columns
        assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == want


def test_kept_places_hold_for_other_cuts_of_a_scan(spark, tmp_path, monkeypatch):
    from tidemark.llm import rows as places

    monkeypatch.setattr(places, "BLOCK", 64)
    path = str(tmp_path / "numbers")
    spark.range(1000).repartition(3).write.option("parquet.block.size", 1024).parquet(path)
    names = ("file", "row")
    numbered = places.placed(spark.read.parquet(path), names)
    listed = str(tmp_path / "listed")
    places.write_places(numbered.where("id % 7 = 0").select("file", "row"), listed)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        again = places.placed(spark.read.parquet(path), names)
        assert again.rdd.getNumPartitions() > 3
        got = sorted(r["id"] for r in places.keep_places(again, names, listed).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(0, 1000, 7))


def test_one_fingerprint_on_a_third_of_all_rows(spark, make_docs):
    rows = [(i, "" if i % 3 == 0 else " ".join(f"w{i}x{j}" for j in range(30)), "en") for i in range(3000)]
    docs = make_docs(rows).repartition(8)
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(docs).collect()}
    assert len(found) == 3000 and all(found[i] == 0 for i in range(0, 3000, 3))
    assert simhash.drop_near_copies(docs).count() == 2001
