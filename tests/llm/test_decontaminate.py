import random
import re

import pytest

from tidemark.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(text, items, window):
    words = WORD.findall((text or "").translate(UPPER))
    hit, found = set(), set()
    for name, item in items:
        own = WORD.findall(item.translate(UPPER))
        size = min(window, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(name)
    return len(words), len(hit), found


@pytest.mark.parametrize("block", [5, 1 << 20])
def test_hits_and_items_match_brute_force(spark, make_docs, block):
    rng = random.Random(2)
    items = [(str(i), " ".join(rng.choice("abÉcd") for _ in range(rng.randint(1, 9)))) for i in range(9)]
    items += [("10", ""), ("3", "d c b a d c"), ("3", "d c b a d c")]
    texts = [" ".join(rng.choice("AbÉcd.") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    docs = make_docs([(i, t, "en") for i, t in enumerate(texts)])
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = decontaminate.leaks(docs, bench, window=4, block_words=block).collect()
    assert len(rows) == len(texts)
    dirty = set()
    for r in rows:
        got = (r["n_words"], r["n_hit"], {m["item_id"] for m in r["matches"]})
        assert got == brute(texts[r["doc_id"]], items, 4)
        assert r["contaminated"] == (r["n_hit"] > 0)
        dirty |= {r["doc_id"]} if r["contaminated"] else set()
    kept = {r["doc_id"] for r in decontaminate.drop_leaks(docs, bench, 4, block).collect()}
    assert kept == set(range(len(texts))) - dirty


def test_the_longest_match_and_its_place(spark, make_docs):
    item = " ".join(f"w{i}" for i in range(30))
    text = "x " + " ".join(f"w{i}" for i in range(5, 17)) + " y " + " ".join(f"w{i}" for i in range(2, 27)) + " z"
    bench = spark.createDataFrame([("a", item)], "item_id string, text string")
    row = decontaminate.leaks(make_docs([(1, text, "en")]), bench).first()
    assert [m.asDict() for m in row["matches"]] == [{"item_id": "a", "start": 14, "n_words": 25}]
    assert row["n_hit"] == 12 + 25


def test_odd_rows(spark, odd_docs, make_docs):
    bench = spark.createDataFrame(
        [("a", "the same text here"), ("b", None), ("c", ""), (None, "no id at all")], "item_id string, text string"
    )
    rows = decontaminate.leaks(odd_docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"]) for r in rows) == [
        (0, 5, 4), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 60000, 0), (5, 4, 4), (5, 4, 4), (6, 1, 0),
    ]
    kept = decontaminate.drop_leaks(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == 5
    none = bench.limit(0)
    assert decontaminate.drop_leaks(odd_docs, none).count() == 8
    assert {r["n_hit"] for r in decontaminate.leaks(odd_docs, none).collect()} == {0}
    assert decontaminate.leaks(make_docs([]), bench).count() == 0


def test_items_without_an_id_hit_and_have_no_name(spark, make_docs):
    docs = make_docs([(1, "one two three four", "en"), (2, "five six seven", "en"), (3, "nothing here", "en")])
    bench = spark.createDataFrame([(None, "one two three"), ("b", "five six"), (None, "six seven")], "item_id string, text string")
    for block in (1, 1000):
        rows = {r["doc_id"]: r for r in decontaminate.leaks(docs, bench, window=3, block_words=block).collect()}
        assert (rows[1]["n_hit"], rows[1]["matches"]) == (3, [])
        assert (rows[2]["n_hit"], [m["item_id"] for m in rows[2]["matches"]]) == (3, ["b"])
        assert [r["doc_id"] for r in decontaminate.drop_leaks(docs, bench, 3, block).collect()] == [3]


def test_one_block_at_a_time(spark):
    """Blocks follow word counts; an item longer than a block is one of its own."""
    items = [("long", " ".join(f"w{i}" for i in range(500)))] + [(str(i), f"a{i} b{i} c{i}") for i in range(40)]
    bench = spark.createDataFrame(items, "item_id string, text string").repartition(5)
    found = list(decontaminate.probes(bench, 10, 30))
    assert 3 < len(found) < 20 and not any(only for only, _ in found)
    assert sorted(n for _, p in found for n in p.names) == sorted(n for n, _ in items)
    assert sorted(len(p.vocabulary) for _, p in found)[-2] <= 33
    assert [only for only, _ in decontaminate.probes(bench, 10)] == [True]


def test_places_with_clashing_names(spark, make_docs):
    docs = make_docs([(i, f"word{i} and more of it", "en") for i in range(50)]).selectExpr("*", "1 AS leak_file", "2 AS LEAK_ROW")
    bench = spark.createDataFrame([(str(i), f"word{i} and") for i in range(0, 50, 5)], "item_id string, text string")
    kept = decontaminate.drop_leaks(docs, bench, 2, 4)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(50) if i % 5]
