"""Cross-validated grid search, scoring and reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.ml.adaboost import AdaBoostModel
from tidemark.ml.grid import Search, Stage, full_search
from tidemark.ml.metrics import best_model, binary_metrics, score_auc, stack_predictions, stack_scores
from tidemark.ml.split import hash_split, stratified_folds, stratified_split
from tidemark.ml.staged import staged_counts
from tidemark.operators.matrix import LABEL, assemble, feature_columns
from tidemark.storage import materialize

_EVALUATED = ("recall", "precision", "accuracy")


@dataclass(frozen=True)
class SearchResult:
    """A finished search: all settings with their mean score, and the refitted best model.

    `fits` counts the models fitted for it, the refitted one included.
    """

    name: str
    metric: str
    param_maps: list[dict]
    scores: list[float]
    best: Model
    fits: int

    def ranked(self) -> list[tuple[dict[str, str], float]]:
        """(params, score), best first; ties keep grid order."""
        named = [{p.name: str(v) for p, v in m.items()} for m in self.param_maps]
        return sorted(zip(named, self.scores), key=lambda s: -s[1])


def _score(cells: tuple[int, int, int, int], metric: str) -> float:
    tp, fp, fn, tn = cells
    part, whole = {"recall": (tp, tp + fn), "precision": (tp, tp + fp), "accuracy": (tp + tn, tp + fp + fn + tn)}[metric]
    return part / whole if whole else 0.0


def fit_grid_search(
    train: DataFrame,
    searches: Sequence[Search] | None = None,
    metric: str = "recall",
    folds: int = 3,
    parallelism: int = 2,
) -> list[SearchResult]:
    """Search each grid with stratified folds. `train` has user_id, label and features.

    Settings that differ only in the number of trees share one fit a fold, of the largest
    number; the others are scored from its first trees (see `staged`).
    """
    if metric not in _EVALUATED:
        raise ValueError(f"metric must be one of {sorted(_EVALUATED)}, not {metric!r}")
    # Every fit reads this table; files outlive the executors that wrote them.
    folded = materialize(stratified_folds(train, "label", folds), "folds").persist(StorageLevel.MEMORY_AND_DISK)
    results = []
    for search in searches or full_search():
        estimator, stages = search.estimator, search.stages()

        def score(job: tuple[Stage, int], estimator=estimator) -> list[tuple[int, int, int, int]]:
            stage, fold = job
            model = estimator.fit(folded.where(F.col("fold") != fold), stage.largest())
            return staged_counts(model, folded.where(F.col("fold") == fold), stage.counts)

        jobs = [(stage, fold) for stage in stages for fold in range(folds)]
        with ThreadPool(parallelism) as pool:
            found = pool.map(inheritable_thread_target(train.sparkSession)(score), jobs)
        maps = search.param_maps()
        scores = [0.0] * len(maps)
        for (stage, _), cells in zip(jobs, found, strict=True):
            for at, cell in zip(stage.places, cells, strict=True):
                scores[at] += _score(cell, metric) / folds
        # Sums of equal scores may differ in their last digit; ties keep grid order.
        best = maps[max(range(len(maps)), key=lambda i: (round(scores[i], 12), -i))]
        results.append(SearchResult(search.name, metric, maps, scores, estimator.fit(folded, best), len(jobs) + 1))
    folded.unpersist()
    return results


def grid_report(spark: SparkSession, results: Sequence[SearchResult]) -> DataFrame:
    """model, rank, params, metric, avg_score: one row per searched setting."""
    rows = [
        (r.name, rank, params, r.metric, float(score))
        for r in results
        for rank, (params, score) in enumerate(r.ranked(), 1)
    ]
    schema = "model string, rank int, params map<string,string>, metric string, avg_score double"
    return spark.createDataFrame(rows, schema)


def predict_and_score(models: dict[str, Model], test: DataFrame) -> DataFrame:
    """Metrics of each model on the test rows; each model predicts once."""
    return binary_metrics(stack_predictions({name: m.transform(test) for name, m in models.items()}))


def score_column(model: Model) -> Column:
    """What orders a model's predictions: the weighted vote, or the probability of label 1."""
    return F.col("rawScore") if isinstance(model, AdaBoostModel) else vector_to_array("probability")[1]


def score_areas(models: dict[str, Model], test: DataFrame) -> DataFrame:
    """`score_auc` of each model on the test rows: the area under its scores, not its 0/1 predictions."""
    scored = {name: m.transform(test) for name, m in models.items()}
    return score_auc(stack_scores(scored, {name: score_column(m) for name, m in models.items()}))


def fit_logistic(train: DataFrame, tolerance: float = 1e-6, rounds: int = 100) -> LogisticRegressionModel:
    """L2-penalised logistic regression, penalty 1 summed over rows, features unscaled."""
    strength = 1.0 / train.count()
    return LogisticRegression(
        regParam=strength, elasticNetParam=0.0, standardization=False, tol=tolerance, maxIter=rounds
    ).fit(train)


def logistic_gradient(model: LogisticRegressionModel, train: DataFrame, features: Sequence[str]) -> DataFrame:
    """item, gradient: the slope of the penalised loss, summed over rows, along each coefficient.

    All of it is zero at the optimum. One pass adds up the rows' slopes.
    """
    off = vector_to_array("probability")[1] - F.col("label")
    x = vector_to_array("features")
    scored = model.transform(train).select(off.alias("off"), x.alias("x"))
    sums = [F.sum(F.col("off") * F.col("x")[i]) + F.lit(float(c)) for i, c in enumerate(model.coefficients.toArray())]
    names = ["intercept", *[f"coefficient:{n}" for n in features]]
    row = scored.agg(*[s.alias(f"g{i}") for i, s in enumerate([F.sum("off"), *sums])])
    items = [F.struct(F.lit(n).alias("item"), F.col(f"g{i}").alias("gradient")) for i, n in enumerate(names)]
    return row.select(F.inline(F.array(*items)))


def logistic_report(
    spark: SparkSession, train: DataFrame, test: DataFrame, features: Sequence[str]
) -> DataFrame:
    """item, value: the intercept and coefficients, then accuracy, precision and recall."""
    model = fit_logistic(train)
    pairs = [("intercept", float(model.intercept))]
    pairs += [(f"coefficient:{n}", float(v)) for n, v in zip(features, model.coefficients.toArray())]
    coefficients = spark.createDataFrame(pairs, "item string, value double")
    scores = predict_and_score({"logistic": model}, test)
    items = F.array(
        *[F.struct(F.lit(m).alias("item"), F.col(m).alias("value")) for m in ("accuracy", "precision", "recall")]
    )
    return coefficients.unionAll(scores.select(F.inline(items)))


@dataclass(frozen=True)
class Evaluation:
    """Outcome of `train_and_evaluate`."""

    results: list[SearchResult]
    report: DataFrame
    scores: DataFrame
    areas: DataFrame
    best_name: str
    best: Model


def split_matrix(
    matrix: DataFrame, features: Sequence[str] | None = None, label: str = LABEL, exact: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Assembled (train, test), 80/20. `exact` splits each label exactly; else by hash alone."""
    # Written before and after the split: the matrix is a long plan that the
    # ranking would run twice, and both sides of the split are read many times.
    vectors = materialize(assemble(matrix, features, label), "vectors")
    if exact:
        parted = stratified_split(vectors, "label").drop("label_rank")
    else:
        parted = hash_split(vectors)
    parted = materialize(parted, "split")
    return parted.where("not is_test").drop("is_test"), parted.where("is_test").drop("is_test")


def train_and_evaluate(
    spark: SparkSession,
    matrix: DataFrame,
    searches: Sequence[Search] | None = None,
    metric: str = "recall",
    folds: int = 3,
    parallelism: int = 2,
    label: str = LABEL,
) -> Evaluation:
    """Split, search every grid, score the refitted winners on the test users, pick the best."""
    train, test = split_matrix(matrix, feature_columns(matrix, label), label)
    results = fit_grid_search(train, searches, metric, folds, parallelism)
    models = {r.name: r.best for r in results}
    scores = predict_and_score(models, test)
    best_name = best_model(scores, metric).first()["model"]
    return Evaluation(results, grid_report(spark, results), scores, score_areas(models, test), best_name, models[best_name])
