import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tidemark.ml import grid, search, split, staged
from tidemark.ml.adaboost import AdaBoostClassifier, AdaBoostModel
from tidemark.ml.metrics import best_model, binary_metrics
from tidemark.operators import ranges


def labels(spark, ones=130, zeros=371):
    n = ones + zeros
    return spark.range(n).selectExpr("id AS user_id", f"CASE WHEN id < {ones} THEN 1 ELSE 0 END AS label")


@pytest.mark.parametrize("partitions", [1, 7])
def test_stratified_split_takes_the_exact_share(spark, partitions):
    df = labels(spark).repartition(partitions)
    parted = split.stratified_split(df, "label").collect()
    assert len(parted) == 501
    for label, n in ((1, 130), (0, 371)):
        ranks = sorted(r.label_rank for r in parted if r.label == label)
        assert ranks == list(range(1, n + 1))
        assert sum(r.is_test for r in parted if r.label == label) == round(0.2 * n)
    again = split.stratified_split(df.repartition(3), "label").where("is_test")
    assert {r.user_id for r in again.collect()} == {r.user_id for r in parted if r.is_test}
    other = split.stratified_split(df, "label", seed=7).where("is_test")
    assert {r.user_id for r in other.collect()} != {r.user_id for r in parted if r.is_test}


def test_hash_split_is_close_to_the_share(spark):
    share = split.hash_split(labels(spark, 1000, 4000)).agg(F.avg(F.col("is_test").cast("int"))).first()[0]
    assert share == pytest.approx(0.2, abs=0.03)


def test_folds_are_balanced_within_labels(spark):
    sizes = split.stratified_folds(labels(spark), "label", 3).groupBy("label", "fold").count().collect()
    assert len(sizes) == 6
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r.label == label]
        assert max(counts) - min(counts) <= 1


def predictions(spark, model, tp, fp, fn, tn):
    rows = [(1, 1)] * tp + [(0, 1)] * fp + [(1, 0)] * fn + [(0, 0)] * tn
    df = spark.createDataFrame(rows, "label int, prediction int")
    return df.withColumn("model", F.lit(model))


def test_metrics_fixture(spark):
    row = binary_metrics(predictions(spark, "a", 169, 15, 0, 481)).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (169, 15, 0, 481)
    got = (row.accuracy, row.precision, row.recall, row.mse, row.auc)
    assert got == pytest.approx((0.977444, 0.918478, 1.0, 0.022556, 0.984879), abs=1e-6)


def test_empty_denominators_give_zero_and_ties_go_to_the_first(spark):
    scores = binary_metrics(predictions(spark, "b", 0, 0, 3, 2).unionAll(predictions(spark, "a", 0, 0, 3, 2)))
    row = scores.where("model = 'a'").first()
    assert (row.precision, row.recall, row.auc) == (0.0, 0.0, 0.5)
    assert best_model(scores).first().model == "a"
    better = scores.unionAll(binary_metrics(predictions(spark, "z", 1, 0, 2, 2)))
    assert best_model(better, "mse").first().model == "z"
    with pytest.raises(ValueError):
        best_model(scores, "r2")


def test_full_grid_size(spark):
    assert [len(s.param_maps()) for s in grid.full_search()] == [128, 200, 20]


@pytest.fixture(scope="module")
def rows(spark):
    """400 users with a noisy, non-linear label."""
    x = [F.rand(i) for i in range(4)]
    base = spark.range(400).select(F.col("id").alias("user_id"), *[c.alias(f"x{i}") for i, c in enumerate(x)])
    noisy = (F.col("x0") * F.col("x1") + 0.15 * F.rand(9) > 0.35).cast("double")
    vector = array_to_vector(F.array(*[F.col(f"x{i}") for i in range(4)]))
    df = base.select("user_id", noisy.alias("label"), vector.alias("features"))
    return df.persist()


@pytest.mark.parametrize("variant", ["SAMME", "SAMME.R"])
def test_boosting_follows_its_definition(spark, rows, variant):
    """Weights recomputed in numpy reproduce every tree of the model."""
    rate = 0.5
    booster = AdaBoostClassifier(maxIter=4, maxDepth=2, variant=variant, learningRate=rate, cutInterval=2)
    model = booster.fit(rows)
    assert len(model.trees) == 4
    table = rows.select("user_id", "label", "features").toPandas().sort_values("user_id")
    y = table["label"].to_numpy()
    w = np.ones(len(y))
    total = np.zeros(len(y))
    for i, (tree, factor) in enumerate(zip(model.trees, model.factors)):
        weights = spark.createDataFrame([(int(u), float(v)) for u, v in zip(table["user_id"], w)], "user_id bigint, w double")
        again = RandomForestClassifier(
            numTrees=1, bootstrap=False, subsamplingRate=1.0, maxDepth=2, featureSubsetStrategy="sqrt", weightCol="w", seed=42 + i
        ).fit(rows.join(weights, "user_id"))
        ours = again.transform(rows).orderBy("user_id").select(vector_to_array("probability")[1].alias("p")).toPandas()["p"].to_numpy()
        theirs = tree.copy().setProbabilityCol("p").setPredictionCol("c").setRawPredictionCol("r").setLeafCol("")
        theirs = theirs.transform(rows).orderBy("user_id").select(vector_to_array("p")[1].alias("q")).toPandas()["q"].to_numpy()
        np.testing.assert_allclose(theirs, ours, atol=1e-9)
        if variant == "SAMME":
            vote = np.where(ours > 0.5, 1.0, -1.0)
            error = w[(vote > 0) != (y == 1)].sum() / w.sum()
            assert factor == pytest.approx(rate * math.log((1 - error) / error))
            w = np.where((vote > 0) != (y == 1), w * math.exp(factor), w)
        else:
            p = np.clip(ours, 1e-12, 1 - 1e-12)
            vote = (np.log(p) - np.log(1 - p)) / 2
            w = w * np.exp(-rate * vote * (2 * y - 1))
        w = w / w.mean()
        total += factor * vote
    scored = model.transform(rows).orderBy("user_id").toPandas()
    np.testing.assert_allclose(scored["rawScore"], total, atol=1e-6)
    assert (scored["prediction"].to_numpy() == (total > 0)).mean() == 1
    assert (scored["prediction"].to_numpy() == y).mean() > max(y.mean(), 1 - y.mean())


def test_boosting_repeats_itself(rows):
    fits = [AdaBoostClassifier(maxIter=2, maxDepth=3).fit(rows.repartition(2, "user_id")) for _ in range(2)]
    assert fits[0].votes == fits[1].votes
    assert [t.toDebugString.split("\n")[1:] for t in fits[0].trees] == [t.toDebugString.split("\n")[1:] for t in fits[1].trees]


def test_many_trees_predict_in_one_flat_plan(rows):
    small = AdaBoostClassifier(maxIter=2, maxDepth=2).fit(rows)
    large = AdaBoostModel(small.trees * 250, small.factors * 250, small.votes * 250)
    scored = small.transform(rows).withColumnRenamed("rawScore", "one").drop("prediction")
    wrong = large.transform(scored).where("abs(rawScore - 250 * one) > 1e-6")
    assert wrong.count() == 0


def test_boosting_stops_at_a_perfect_tree(spark):
    df = spark.range(40).select(
        F.col("id").alias("user_id"),
        (F.col("id") >= 20).cast("double").alias("label"),
        array_to_vector(F.array(F.col("id").cast("double"))).alias("features"),
    )
    model = AdaBoostClassifier(maxIter=10, maxDepth=1, variant="SAMME").fit(df)
    assert len(model.trees) == 1 and model.factors == [1.0]
    assert model.transform(df).where("prediction <> label").count() == 0
    with pytest.raises(ValueError):
        AdaBoostClassifier(variant="SAMME.Q").fit(df)


def test_training_job(spark, rows):
    table = rows.select("user_id", F.col("label").cast("int").alias("churned"), vector_to_array("features").alias("f"))
    matrix = table.select("user_id", "churned", *[F.col("f")[i].alias(f"x{i}") for i in range(4)])
    searches = [
        grid.gradient_boosting({"maxIter": [2, 4], "maxDepth": [2]}),
        grid.adaboost({"maxIter": [2], "maxDepth": [1]}),
        grid.random_forest({"numTrees": [3]}, max_depth=3),
    ]
    outcome = search.train_and_evaluate(spark, matrix, searches, metric="accuracy")
    report = outcome.report.collect()
    assert [(r.model, r["rank"]) for r in report] == [
        ("gradient_boosting", 1), ("gradient_boosting", 2), ("adaboost", 1), ("random_forest", 1),
    ]
    assert report[0].avg_score >= report[1].avg_score
    assert report[0].params.keys() == {"maxIter", "maxDepth"}
    scores = {r.model: r for r in outcome.scores.collect()}
    assert sum((scores["adaboost"].tp, scores["adaboost"].fp, scores["adaboost"].fn, scores["adaboost"].tn)) == 80
    assert outcome.best_name == max(sorted(scores), key=lambda m: scores[m].accuracy)
    assert all(s.accuracy > 0.6 for s in scores.values())


def test_first_trees_of_boosting_are_shorter_fits(rows):
    for estimator in (
        GBTClassifier(maxDepth=2, stepSize=0.5, featureSubsetStrategy="sqrt", seed=7),
        AdaBoostClassifier(maxDepth=2, seed=7),
    ):
        whole = estimator.fit(rows, {estimator.maxIter: 7})
        for count in (1, 4, 7, 9):
            own = estimator.fit(rows, {estimator.maxIter: min(count, 7)}).transform(rows)
            part = staged.first_trees(whole, count).transform(rows)
            score = F.col("rawScore") if "rawScore" in own.columns else vector_to_array("rawPrediction")[1]
            pairs = own.select("user_id", score.alias("a"), F.col("prediction").alias("b")).join(
                part.select("user_id", score.alias("c"), F.col("prediction").alias("d")), "user_id"
            )
            # Sums of weights may differ in their last digit from run to run.
            assert all(r.a == pytest.approx(r.c, abs=1e-9) and r.b == r.d for r in pairs.collect())


def test_first_trees_of_a_forest_are_a_forest(rows):
    whole = RandomForestClassifier(numTrees=5, maxDepth=3, seed=3).fit(rows)
    part = staged.first_trees(whole, 2)
    assert [t.toDebugString for t in part.trees] == [t.toDebugString for t in whole.trees[:2]]
    scored = part.transform(rows).select("features", vector_to_array("probability")[1].alias("p"))
    for i, tree in enumerate(part.trees):
        scored = tree.setPredictionCol("").setRawPredictionCol("").setProbabilityCol(f"t{i}").transform(scored)
    mean = (vector_to_array("t0")[1] + vector_to_array("t1")[1]) / 2
    assert scored.where(F.abs(F.col("p") - mean) > 1e-9).count() == 0
    with pytest.raises(TypeError):
        staged.first_trees(search.fit_logistic(rows), 2)


def test_full_search_needs_a_fit_per_tree_setting_only(spark):
    assert [len(s.stages()) for s in grid.full_search()] == [32, 40, 4]
    for s in grid.full_search():
        assert sorted(p for stage in s.stages() for p in stage.places) == list(range(len(s.param_maps())))


def test_staged_scores_are_those_of_separate_fits(spark, rows, monkeypatch):
    fits = []
    estimators = {"gradient_boosting": GBTClassifier, "adaboost": AdaBoostClassifier}
    for kind in estimators.values():
        monkeypatch.setattr(kind, "_fit", lambda self, data, f=kind._fit: fits.append(type(self)) or f(self, data))
    searches = [
        grid.gradient_boosting({"maxIter": [2, 3, 5], "maxDepth": [1, 2]}),
        grid.adaboost({"maxDepth": [1], "maxIter": [4, 2]}),
    ]
    results = search.fit_grid_search(rows, searches, "accuracy")
    assert [r.fits for r in results] == [2 * 3 + 1, 3 + 1] and len(fits) == 11
    folded = split.stratified_folds(rows, "label", 3)
    for result, wanted in zip(results, searches):
        for setting, score in zip(result.param_maps, result.scores):
            own = []
            for fold in range(3):
                model = wanted.estimator.fit(folded.where(f"fold <> {fold}"), setting)
                said = model.transform(folded.where(f"fold = {fold}")).select(F.avg((F.col("prediction") == F.col("label")).cast("int")))
                own.append(said.first()[0])
            assert score == pytest.approx(np.mean(own))
        assert result.ranked()[0][1] == pytest.approx(max(result.scores))
        best = result.param_maps[int(np.argmax(np.round(result.scores, 12)))]
        assert all(result.best.getOrDefault(p.name) == v for p, v in best.items())


def test_score_auc_counts_ties_half(spark):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for model, values in (("coarse", 5), ("fine", 10**6), ("one", 1)):
        score, label = rng.integers(0, values, 500) / 7, rng.integers(0, 2, 500)
        rows += [(model, int(y), float(x)) for x, y in zip(score, label)]
        yes, no = score[label == 1], score[label == 0]
        want[model] = ((yes[:, None] > no).sum() + (yes[:, None] == no).sum() / 2) / (len(yes) * len(no))
    rows += [("fine", 1, None), ("fine", None, 0.5), ("only", 1, 0.3)]
    got = search.score_auc(spark.createDataFrame(rows, "model string, label int, score double").repartition(7))
    areas = {r.model: r.score_auc for r in got.collect()}
    assert areas.pop("only") is None
    assert areas == pytest.approx(want)


def test_areas_of_models(rows):
    models = {"boost": AdaBoostClassifier(maxIter=3).fit(rows), "forest": RandomForestClassifier(numTrees=3, seed=1).fit(rows)}
    areas = {r.model: r.score_auc for r in search.score_areas(models, rows).collect()}
    for name, model in models.items():
        raw = "rawScore" if name == "boost" else "rawPrediction"
        judge = BinaryClassificationEvaluator(rawPredictionCol=raw, numBins=0)
        assert areas[name] == pytest.approx(judge.evaluate(model.transform(rows)), abs=1e-9)


def test_totals_before_in_any_layout(spark):
    rng = np.random.default_rng(2)
    rows = [(int(g), i, int(v)) for i, (g, v) in enumerate(zip(rng.integers(0, 3, 400), rng.integers(0, 9, 400)))]
    df = spark.createDataFrame(rows, "g int, i int, v int").repartition(5)
    running, want = {}, {}
    for g, i, v in rows:
        want[i] = running.get(g, 0)
        running[g] = want[i] + v
    for n in (1, 7):
        got = ranges.totals_before(df, ["i"], {"before": "v"}, ["g"], n)
        assert got.columns == ["g", "i", "v", "before"]
        assert {r.i: r.before for r in got.collect()} == want


def test_logistic_report(spark, rows):
    train, test = rows.where("user_id % 5 <> 0"), rows.where("user_id % 5 = 0")
    report = {r.item: r.value for r in search.logistic_report(spark, train, test, ["a", "b", "c", "d"]).collect()}
    assert set(report) == {"intercept", *(f"coefficient:{c}" for c in "abcd"), "accuracy", "precision", "recall"}
    assert report["coefficient:a"] > 0 and report["coefficient:b"] > 0
    # The optimum of the penalised loss: its gradient vanishes.
    table = train.toPandas()
    x, y = np.array([v.toArray() for v in table["features"]]), table["label"].to_numpy()
    beta = np.array([report[f"coefficient:{c}"] for c in "abcd"])
    p = 1 / (1 + np.exp(-(x @ beta + report["intercept"])))
    np.testing.assert_allclose(x.T @ (p - y) + beta, 0, atol=0.05)
