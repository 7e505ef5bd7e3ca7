"""Scores of 0/1 predictions, all from the four confusion counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranges import totals_before

METRICS = ("precision", "recall", "accuracy", "auc", "mse")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def binary_metrics(predictions: DataFrame) -> DataFrame:
    """One row per model from (model, label, prediction).

    AUC is that of the hard prediction, (TPR + TNR) / 2, and MSE the error
    rate. A ratio with an empty denominator is 0.
    """
    yes, said = F.col("label") == 1, F.col("prediction") == 1
    cells = predictions.groupBy("model").agg(
        F.count_if(yes & said).alias("tp"),
        F.count_if(~yes & said).alias("fp"),
        F.count_if(yes & ~said).alias("fn"),
        F.count_if(~yes & ~said).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    return cells.select(
        "*",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp + tn, total).alias("accuracy"),
        ((_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2).alias("auc"),
        _ratio(fp + fn, total).alias("mse"),
    )


def best_model(scores: DataFrame, metric: str = "recall") -> DataFrame:
    """The row with the best metric (lowest for mse); ties go to the first model by name."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
    order = F.asc(metric) if metric == "mse" else F.desc(metric)
    return scores.orderBy(order, "model").limit(1)


def stack_predictions(by_model: dict[str, DataFrame]) -> DataFrame:
    """Tag each model's predictions with its name and append them."""
    tagged = [
        df.select(F.lit(name).alias("model"), "label", "prediction") for name, df in by_model.items()
    ]
    return reduce(DataFrame.unionAll, tagged)


def score_auc(predictions: DataFrame) -> DataFrame:
    """model, positives, negatives, score_auc from (model, label, score).

    The chance that a row of label 1 has a higher score than one of label 0, ties counting
    half: the rank sum. Rows count per distinct score before they are ordered, and running
    counts are taken over ranges of scores, so no task orders all of them. Rows without a
    score or label do not count; with only one label there is no area.
    """
    yes = F.col("label") == 1
    counts = (
        predictions.where(F.col("score").isNotNull() & F.col("label").isNotNull())
        .groupBy("model", F.col("score").cast("double").alias("score"))
        .agg(F.count_if(yes).alias("yes"), F.count_if(~yes).alias("no"))
    )
    ranked = totals_before(counts, ["score"], {"below": "no"}, group=["model"])
    # Twice the pairs won, in whole numbers of any size.
    won = F.col("yes").cast("decimal(19,0)") * (2 * F.col("below") + F.col("no")).cast("decimal(19,0)")
    sums = ranked.groupBy("model").agg(F.sum("yes").alias("positives"), F.sum("no").alias("negatives"), F.sum(won).alias("won"))
    pairs = 2 * F.col("positives").cast("double") * F.col("negatives")
    return sums.select("model", "positives", "negatives", F.try_divide(F.col("won").cast("double"), pairs).alias("score_auc"))


def stack_scores(by_model: dict[str, DataFrame], columns: dict[str, Column]) -> DataFrame:
    """(model, label, score) of each model's predictions; `columns` has each model's score."""
    tagged = [df.select(F.lit(name).alias("model"), "label", columns[name].alias("score")) for name, df in by_model.items()]
    return reduce(DataFrame.unionAll, tagged)
