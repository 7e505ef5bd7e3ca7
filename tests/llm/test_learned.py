import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, toxicity
from tidemark.llm.common import fold, stratified

SAMPLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SAMPLE}/documents.parquet")


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    cell = langid.Cell(rng.standard_normal((256, 9)).astype(np.float32), rng.standard_normal((3, 9)).astype(np.float32))
    grid = rng.integers(0, 256, (5, 4)).astype(np.uint8)
    pull = rng.standard_normal((5, 4, 3)).astype(np.float32)

    def loss():
        return float((langid._states(cell, grid).swapaxes(1, 2) * pull).sum(dtype=np.float64))

    by_byte, by_state = langid._cell_backward(cell, grid, pull)
    for array, grad in ((cell.by_state, by_state), (cell.by_byte, by_byte)):
        for at in [(int(grid[2, 1]) % array.shape[0], 4), (int(grid[0, 0]) % array.shape[0], 7)]:
            old = array[at]
            array[at] = old + 1e-2
            up = loss()
            array[at] = old - 1e-2
            down = loss()
            array[at] = old
            assert grad[at] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=0.02)


def test_held_out_languages(docs):
    net = langid.train(docs.where(fold(3) != 1))
    rows = langid.predict(docs, net, ["doc_id", "lang"]).where(fold(3) == 1).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_rows(odd_docs, make_docs):
    net = langid.fit([("en", b"the words of the text"), ("fr", b"les mots du texte")], steps=3)
    rows = {(r["doc_id"], r["lang_pred"] == "und", r["score"] > 0) for r in langid.predict(odd_docs, net).collect()}
    assert rows == {(1, True, False), (2, True, False), (3, True, False), (6, True, False)} | {
        (i, False, True) for i in (4, 5, None)
    }
    kept = langid.keep_known(odd_docs, net, 0.0)
    assert kept.columns == odd_docs.columns and kept.count() == 4
    assert langid.train(make_docs([])) is None and langid.train(make_docs([(1, "a", None)])) is None
    assert {r["lang_pred"] for r in langid.predict(odd_docs, None).collect()} == {"und"}
    assert langid.predict(make_docs([]), net).count() == 0
    assert langid.train(make_docs([(1, "only one", "en")])).languages == ["en"]


def test_a_language_of_empty_texts_takes_no_part(make_docs):
    words = {"en": "the house of the river and the stone", "fr": "les mots du texte et une maison"}
    rows = [(i, f"{words[x]} {i % 9} " * 4, x) for i in range(80) for x in [("en", "fr")[i % 2]]]
    docs = make_docs([*rows, (100, "", "und"), (101, "", "")])
    net = langid.train(docs)
    assert net.languages == ["en", "fr"]
    found = {r["doc_id"]: r for r in langid.predict(docs, net).collect()}
    assert all(found[i]["lang_pred"] == x and found[i]["score"] > 0.8 for i, _, x in rows)
    assert langid.train(make_docs([(1, "", "en"), (2, "", "fr")])) is None


def test_every_stratum_is_sampled(spark):
    rows = spark.range(2600).selectExpr("id", "id div 2 as kind")
    assert stratified(rows, "kind", F.xxhash64("id"), 300).select("kind").distinct().count() == 1300


def test_a_sample_is_bounded_as_a_whole(spark, monkeypatch):
    from tidemark.llm import common

    monkeypatch.setattr(common, "FULL_STRATA", 10)
    rows = spark.range(50_000).selectExpr("id", "id % 5000 as kind")
    for per, most in ((20, 200), (300, 3000)):
        got = stratified(rows, "kind", F.xxhash64("id"), per).count()
        assert 0.7 * most < got < 1.3 * most
    few = stratified(rows.selectExpr("id", "id % 4 as kind"), "kind", F.xxhash64("id"), 100)
    assert all(60 < r["count"] < 140 for r in few.groupBy("kind").count().collect())
    assert stratified(rows.limit(0), "kind", F.xxhash64("id"), 5).count() == 0


def test_windows_do_not_change_with_the_batch():
    net = langid.fit([("en", b"the words of the text"), ("fr", b"les mots du texte")], steps=3)
    docs = [b"x" * n for n in (0, 1, 63, 64, 65, 1000)]
    whole = langid.document_probabilities(net, docs)
    for i, d in enumerate(docs):
        assert np.allclose(langid.document_probabilities(net, [d])[0], whole[i], atol=1e-5)


def test_machine_scores_all_pairs():
    rng = np.random.default_rng(2)
    slot = np.full(toxicity.BUCKETS, -1, np.int32)
    slot[:6] = np.arange(6)
    machine = toxicity.Machine(slot, 0.3, rng.standard_normal(6), rng.standard_normal((6, 3)))
    sets = [np.array(s, np.int32) for s in ([], [1], [0, 2, 5], [1, 3, 4, 5, 77])]
    for buckets, got in zip(sets, machine.score(sets), strict=True):
        own = [b for b in buckets if b < 6]
        odds = 0.3 + sum(machine.weights[i] for i in own)
        odds += sum(machine.vectors[i] @ machine.vectors[j] for i in own for j in own if i < j)
        assert got == pytest.approx(1 / (1 + np.exp(-odds)))


def test_pairs_are_learned(make_docs):
    """Neither word alone is toxic, the two together are."""
    rng = np.random.default_rng(5)
    sets, labels = [], []
    for _ in range(600):
        own = [b for b in (10, 20, 30, 40) if rng.random() < 0.5]
        sets.append(np.array(own, np.int32))
        labels.append(int(10 in own and 20 in own))
    machine = toxicity.fit(sets, np.array(labels), np.ones(600), steps=800, decay=0)
    both, one, other = machine.score([np.array(x, np.int32) for x in ([10, 20], [10, 30], [20, 40])])
    assert both > 0.8 > 0.3 > max(one, other)


def test_pairs_without_margins_are_learned():
    """Two words as common in either label; only whether both or neither are there counts."""
    rng = np.random.default_rng(8)
    sets = [np.flatnonzero(rng.random(40) < 0.5).astype(np.int32) for _ in range(1600)]
    labels = np.array([int((0 in s) == (1 in s)) for s in sets])
    machine = toxicity.fit(sets[:1200], labels[:1200], np.ones(1200))
    assert np.mean((machine.score(sets[1200:]) >= 0.5) == labels[1200:]) > 0.9
    assert (machine.slot[:40] >= 0).all()


@pytest.fixture(scope="module")
def real_terms(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 3 = 0").orderBy("doc_id")
    return [toxicity.term_buckets((r["text"] or "").encode()) for r in rows.select("doc_id", "text").collect()]


def test_a_planted_pair_in_real_texts(real_terms):
    """Both words are as common in either label, among 20,000 other buckets; only the pair tells."""
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 2, len(real_terms))
    sets = []
    for own, label in zip(real_terms, labels, strict=True):
        first, second = rng.random() < 0.5, rng.random() < 0.5
        planted = ([7, 13] if first else []) if label else ([7] if second else [13])
        sets.append(np.array(sorted(set(own.tolist()) - {7, 13} | set(planted)), np.int32))
    assert len(np.unique(np.concatenate(sets))) > 20_000
    apart = np.arange(len(sets)) % 5 == 0
    learn = [s for s, a in zip(sets, apart, strict=True) if not a]
    held = [s for s, a in zip(sets, apart, strict=True) if a]

    def accuracy(**options):
        machine = toxicity.fit(learn, labels[~apart], np.ones(len(learn)), **options)
        return np.mean((machine.score(held) >= 0.5) == labels[apart]), machine

    with_pairs, machine = accuracy()
    without, _ = accuracy(pairs=False)
    assert with_pairs > 0.95 and with_pairs - without > 0.3
    # Only terms of pairs that stand out have vectors.
    assert set(np.flatnonzero(np.abs(machine.vectors).sum(1)).tolist()) >= set(machine.slot[[7, 13]].tolist())


def test_strong_pairs_equal_brute_force():
    rng = np.random.default_rng(6)
    places = [np.flatnonzero(rng.random(30) < 0.4) for _ in range(800)]
    miss = np.array([0.5 if (3 in p) == (4 in p) else -0.5 for p in places]) * rng.random(800)
    found, effects = toxicity.strong_pairs(places, miss, np.full(800, 0.25))
    want = {}
    holds = np.array([[i in p for p in places] for i in range(30)])
    for i in range(30):
        for j in range(i):
            both = holds[i] & holds[j]
            if both.sum() >= toxicity.PAIR_DOCS:
                rest = miss[both] - miss[holds[i]].mean() - miss[holds[j]].mean() + miss.mean()
                if abs(rest.sum()) > toxicity.PAIR_SIGMA * np.sqrt((rest**2).sum()):
                    want[j, i] = np.clip(rest.sum() / (0.25 * both.sum() + 1), -4, 4)
    got = {tuple(p): e for p, e in zip(found.tolist(), effects.tolist(), strict=True)}
    assert (3, 4) in want and got == pytest.approx(want)
    vectors = toxicity.starting_vectors(np.array([[3, 4]]), np.array([2.0]), 30, 8)
    assert vectors[3] @ vectors[4] == pytest.approx(2.0, abs=1e-5)
    opposed = toxicity.starting_vectors(np.array([[0, 1], [1, 2]]), np.array([1.5, -1.0]), 30, 8)
    assert (opposed[0] @ opposed[1], opposed[1] @ opposed[2]) == pytest.approx((1.5, -1.0), abs=1e-5)
    none, _ = toxicity.strong_pairs([np.arange(3)] * 5, np.zeros(5), np.ones(5))
    assert none.shape == (0, 2)


def test_settings_are_chosen_within_the_learning_rows(real_terms, monkeypatch):
    rng = np.random.default_rng(4)
    labels = rng.integers(0, 2, 600)
    seen = []
    whole = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda sets, *a, **k: seen.append((len(sets), k)) or whole(sets, *a, **k, steps=20))
    toxicity.fit_chosen(real_terms[:600], labels, np.ones(600))
    assert [k.get("pairs") for _, k in seen[:4]] == [False, False, False, True]
    assert {n for n, _ in seen[:4]} == {seen[0][0]} and 400 < seen[0][0] < 600 and seen[4][0] == 600
    seen.clear()
    toxicity.fit_chosen(real_terms[:12], labels[:12], np.ones(12))
    assert seen == [(12, {})]


def test_toxic_words_are_learned(spark, make_docs):
    rows = [(i, f"some plain words {i % 7} " + ("you idiot moron" if i % 4 == 0 else "of course"), "en") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 400, 2)] + [(3, None)], "doc_id long, toxic int")
    docs = make_docs(rows)
    found = {r["doc_id"]: r for r in toxicity.judge(docs, toxicity.train(docs, labels)).collect()}
    assert all(found[i]["predicted"] == int(i % 4 == 0) for i in range(400))


def test_toxicity_of_odd_rows(spark, odd_docs, make_docs):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.judge(odd_docs, toxicity.train(odd_docs, labels)).collect()
    assert len(rows) == 8 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    none = make_docs([])
    assert toxicity.train(odd_docs, labels.limit(0)) is None and toxicity.train(none, labels) is None
    assert {r["score"] for r in toxicity.judge(odd_docs, None).collect()} == {0.0}
    assert toxicity.judge(none, None).count() == 0
