"""Scores of all tree counts from one fit of the largest.

Boosting adds trees one by one, each from those before it, so the first k trees of a long
fit are the fit of k trees. A forest's trees do not depend on one another: its first k are
a forest of k trees, though not the one that a fit of k with the same seed draws, because
Spark draws the rows and features of all trees in turn from one stream.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.ml.adaboost import AdaBoostModel

_ML = "org.apache.spark.ml"


def _java_array(items: Sequence, kind: str):
    jvm = SparkContext._gateway.jvm
    for part in kind.split("."):
        jvm = getattr(jvm, part)
    return JavaWrapper._new_java_array(list(items), jvm)


def _new(kind: str, *args):
    return JavaWrapper._new_java_obj(f"{_ML}.classification.{kind}", f"first_{uuid.uuid4().hex[:12]}", *args)


def first_trees(model: Model, count: int) -> Model:
    """The model of the first `count` trees; all of them where it has fewer."""
    if isinstance(model, AdaBoostModel):
        short = AdaBoostModel(model.trees[:count], model.factors[:count], model.votes[:count])
        return model._copyValues(short)
    if isinstance(model, GBTClassificationModel):
        trees = [t._java_obj for t in model.trees[:count]]
        array = _java_array(trees, f"{_ML}.regression.DecisionTreeRegressionModel")
        weights = _java_array([float(w) for w in model.treeWeights[: len(trees)]], "double")
        java = _new("GBTClassificationModel", array, weights, model.numFeatures, model.numClasses)
        return model._copyValues(GBTClassificationModel(java))
    if isinstance(model, RandomForestClassificationModel):
        trees = [t._java_obj for t in model.trees[:count]]
        array = _java_array(trees, f"{_ML}.classification.DecisionTreeClassificationModel")
        java = _new("RandomForestClassificationModel", array, model.numFeatures, model.numClasses)
        return model._copyValues(RandomForestClassificationModel(java))
    raise TypeError(f"{type(model).__name__} is not made of trees in order")


def staged_counts(model: Model, rows: DataFrame, counts: Sequence[int | None]) -> list[tuple[int, int, int, int]]:
    """(tp, fp, fn, tn) on `rows` of the first trees, for each count (None: all trees), in one pass."""
    scored = rows.select("label", "features")
    for i, count in enumerate(counts):
        part = model.copy() if count is None else first_trees(model, count)
        for name in ("rawPredictionCol", "probabilityCol", "leafCol"):
            if part.hasParam(name):
                part.set(part.getParam(name), "")
        part.set(part.getParam("predictionCol"), f"said_{i}")
        scored = part.transform(scored).select("label", "features", *[f"said_{j}" for j in range(i + 1)])
    yes = F.col("label") == 1
    cells = []
    for i in range(len(counts)):
        said = F.col(f"said_{i}") == 1
        cells += [F.count_if(yes & said), F.count_if(~yes & said), F.count_if(yes & ~said), F.count_if(~yes & ~said)]
    found = scored.agg(*[c.alias(f"c{i}") for i, c in enumerate(cells)]).first()
    return [tuple(found[4 * i : 4 * i + 4]) for i in range(len(counts))]
