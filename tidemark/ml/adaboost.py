"""AdaBoost over shallow trees, as a ``pyspark.ml`` estimator.

Implements the two-class case of stagewise additive modelling with exponential
loss (Zhu, Zou, Rosset and Hastie, 2009): SAMME re-weights by the error of the
hard votes, SAMME.R by the class probabilities. Each round fits one weighted
Spark tree on all rows; the row weights are a column.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

from pyspark import SparkContext, StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasSeed
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.storage import materialize

_WEIGHT = "_boost_weight"
_OUTPUT = "_boost_output"
_LEAF = "_boost_leaf"
_SCORE = "_boost_score"
_TINY = 1e-12


class _AdaBoostParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasSeed):
    learningRate = Param(
        Params._dummy(), "learningRate", "shrinks each tree's contribution", TypeConverters.toFloat
    )
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of each tree", TypeConverters.toInt)
    featureSubsetStrategy = Param(
        Params._dummy(), "featureSubsetStrategy", "features tried per split", TypeConverters.toString
    )
    variant = Param(Params._dummy(), "variant", "'SAMME' or 'SAMME.R'", TypeConverters.toString)
    cutInterval = Param(
        Params._dummy(), "cutInterval", "rounds between two cuts of the weight lineage", TypeConverters.toInt
    )

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(
            maxIter=50,
            learningRate=1.0,
            maxDepth=2,
            featureSubsetStrategy="sqrt",
            variant="SAMME.R",
            cutInterval=5,
            seed=42,
        )


def _vote(variant: str) -> Column:
    """A tree's signed vote from its class probabilities: +1/-1, or half the log odds."""
    p = vector_to_array(F.col(_OUTPUT))[1]
    if variant == "SAMME":
        return F.when(p > 0.5, 1.0).otherwise(-1.0)
    inner = F.least(F.greatest(p, F.lit(_TINY)), F.lit(1 - _TINY))
    return (F.log(inner) - F.log(1 - inner)) / 2


class AdaBoostClassifier(Estimator, _AdaBoostParams):
    @keyword_only
    def __init__(
        self,
        *,
        featuresCol="features",
        labelCol="label",
        predictionCol="prediction",
        maxIter=50,
        learningRate=1.0,
        maxDepth=2,
        featureSubsetStrategy="sqrt",
        variant="SAMME.R",
        cutInterval=5,
        seed=42,
    ):
        super().__init__()
        self._set(**self._input_kwargs)

    def _tree(self, round_no: int) -> RandomForestClassifier:
        return RandomForestClassifier(
            numTrees=1,
            bootstrap=False,
            subsamplingRate=1.0,
            maxDepth=self.getOrDefault("maxDepth"),
            featureSubsetStrategy=self.getOrDefault("featureSubsetStrategy"),
            featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(),
            weightCol=_WEIGHT,
            seed=self.getSeed() + round_no,
            predictionCol="",
            rawPredictionCol="",
            probabilityCol=_OUTPUT,
            leafCol=_LEAF,
        )

    def _fit(self, dataset: DataFrame) -> AdaBoostModel:
        variant = self.getOrDefault("variant")
        if variant not in ("SAMME", "SAMME.R"):
            raise ValueError(f"variant must be 'SAMME' or 'SAMME.R', not {variant!r}")
        rate = self.getOrDefault("learningRate")
        interval = self.getOrDefault("cutInterval")
        label = F.col(self.getLabelCol())
        # Two classes, said once: else every round counts them.
        classes = {"ml_attr": {"type": "nominal", "vals": ["0", "1"], "name": self.getLabelCol()}}
        rows = dataset.select(self.getFeaturesCol(), label.alias(self.getLabelCol(), metadata=classes))
        data = materialize(rows.withColumn(_WEIGHT, F.lit(1.0)), "boost-rows")
        trees, factors, votes = [], [], []
        previous = None
        for round_no in range(self.getMaxIter()):
            tree = self._tree(round_no).fit(data)
            if previous is not None:
                # The fit has filled the cache of `data`, so its parent can go.
                previous.unpersist()
            voted = tree.transform(data).withColumn(_SCORE, _vote(variant))
            wrong = (F.col(_SCORE) > 0) != (label == 1)
            # One row per leaf, at most 2^maxDepth: all the driver sees of a round.
            leaves = (
                voted.groupBy(vector_to_array(F.col(_LEAF))[0].cast("int").alias("leaf"))
                .agg(
                    F.max(_SCORE).alias("vote"),
                    F.count(F.lit(1)).alias("rows"),
                    F.sum(_WEIGHT).alias("total"),
                    F.sum(F.when(wrong, F.col(_WEIGHT)).otherwise(0.0)).alias("wrong"),
                )
                .orderBy("leaf")
                .collect()
            )
            n, total = sum(r["rows"] for r in leaves), sum(r["total"] for r in leaves)
            error = sum(r["wrong"] for r in leaves) / total
            hopeless = variant == "SAMME" and error >= 0.5
            if hopeless and trees:
                data.unpersist()
                break
            factor = 1.0
            if variant == "SAMME" and 0 < error < 0.5:
                factor = rate * math.log((1 - error) / error)
            trees.append(tree.trees[0])
            factors.append(factor)
            table = [0.0] * (max(r["leaf"] for r in leaves) + 1)
            for r in leaves:
                table[r["leaf"]] = factor * r["vote"]
            votes.append(table)
            if hopeless or error <= 0 or round_no == self.getMaxIter() - 1:
                data.unpersist()
                break
            if variant == "SAMME":
                growth = F.when(wrong, F.exp(F.lit(factor))).otherwise(F.lit(1.0))
            else:
                growth = F.exp(F.lit(-rate) * F.col(_SCORE) * (2 * label - 1))
            # Weights of this round are scaled to mean 1: trees do not change, numbers stay in range.
            scaled = F.col(_WEIGHT) * growth * F.lit(n / total)
            grown = voted.select(self.getFeaturesCol(), self.getLabelCol(), scaled.alias(_WEIGHT))
            if (round_no + 1) % interval == 0:
                following = materialize(grown, "boost-rows")
            else:
                following = grown.persist(StorageLevel.MEMORY_AND_DISK)
            previous, data = data, following
        return self._copyValues(AdaBoostModel(trees, factors, votes))


def _forest(trees: Sequence[DecisionTreeClassificationModel]) -> RandomForestClassificationModel:
    """The trees as one Spark model, which finds all leaves of a row in one step."""
    kind = "org.apache.spark.ml.classification.RandomForestClassificationModel"
    tree_class = SparkContext._gateway.jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel
    array = JavaWrapper._new_java_array([t._java_obj for t in trees], tree_class)
    uid = f"boosted_{uuid.uuid4().hex[:12]}"
    java = JavaWrapper._new_java_obj(kind, uid, array, trees[0].numFeatures, 2)
    return RandomForestClassificationModel(java)


class AdaBoostModel(Model, _AdaBoostParams):
    """The fitted trees; ``rawScore`` is their weighted vote, positive for label 1.

    `votes` holds each tree's vote by leaf, times the tree's factor. The plan
    of a prediction has the same size for any number of trees.
    """

    def __init__(self, trees=(), factors=(), votes=()):
        super().__init__()
        self.trees = list(trees)
        self.factors = list(factors)
        self.votes = [list(v) for v in votes]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        forest = _forest(self.trees)
        for unset in ("prediction", "probability", "rawPrediction"):
            forest.set(forest.getParam(f"{unset}Col"), "")
        forest.setFeaturesCol(self.getFeaturesCol()).setLeafCol(_LEAF)
        # Folded to a constant by the optimizer.
        tables = F.from_json(F.lit(json.dumps(self.votes)), "array<array<double>>")
        leaves = vector_to_array(F.col(_LEAF))
        each = F.zip_with(leaves, tables, lambda leaf, table: F.get(table, leaf.cast("int")))
        score = F.aggregate(each, F.lit(0.0), lambda total, vote: total + vote)
        scored = forest.transform(dataset).withColumn("rawScore", score).drop(_LEAF)
        return scored.withColumn(self.getPredictionCol(), (F.col("rawScore") > 0).cast("double"))
