"""The three classifiers and their parameter grids."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from typing import Any

from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.param import Param

from tidemark.ml.adaboost import AdaBoostClassifier

SEED = 42

# The searched settings.
GRADIENT_BOOSTING = {
    "stepSize": [1.0, 0.5, 0.2, 0.05],
    "maxDepth": [2, 4, 8, 10],
    "featureSubsetStrategy": ["sqrt", "log2"],
    "maxIter": [50, 75, 100, 200],
}
ADABOOST = {
    "learningRate": [1.0, 0.5, 0.2, 0.05],
    "maxDepth": [2, 4, 6, 8, 10],
    "featureSubsetStrategy": ["sqrt", "log2"],
    "maxIter": [50, 100, 200, 300, 500],
}
RANDOM_FOREST = {
    "numTrees": [50, 100, 200, 300, 500],
    "featureSubsetStrategy": ["sqrt", "log2"],
    "minInstancesPerNode": [1, 2],
}


@dataclass(frozen=True)
class Stage:
    """Settings that differ only in the number of trees: the param maps' places in the grid, and the numbers."""

    params: dict
    trees: Param | None
    counts: list[int | None]
    places: list[int]

    def largest(self) -> dict:
        """The one setting to fit."""
        return self.params if self.trees is None else self.params | {self.trees: max(self.counts)}


@dataclass(frozen=True)
class Search:
    """One classifier and the values to try for each of its params.

    `trees` names the param that counts trees, whose smaller values need no fit of their own.
    """

    name: str
    estimator: Estimator
    grid: dict[str, list[Any]]
    trees: str | None = None

    def param_maps(self) -> list[dict]:
        """Every combination of the grid as a param map."""
        params = [self.estimator.getParam(name) for name in self.grid]
        return [dict(zip(params, values)) for values in product(*self.grid.values())]

    def stages(self) -> list[Stage]:
        """The grid in groups that share a fit, in grid order."""
        trees = self.estimator.getParam(self.trees) if self.trees in self.grid else None
        found: dict[tuple, Stage] = {}
        for place, setting in enumerate(self.param_maps()):
            rest = {p: v for p, v in setting.items() if p != trees}
            stage = found.setdefault(tuple(rest.values()), Stage(rest, trees, [], []))
            stage.counts.append(setting.get(trees))
            stage.places.append(place)
        return list(found.values())


def gradient_boosting(grid: dict[str, list[Any]] | None = None) -> Search:
    return Search("gradient_boosting", GBTClassifier(seed=SEED), grid or GRADIENT_BOOSTING, "maxIter")


def adaboost(grid: dict[str, list[Any]] | None = None) -> Search:
    return Search("adaboost", AdaBoostClassifier(seed=SEED), grid or ADABOOST, "maxIter")


def random_forest(grid: dict[str, list[Any]] | None = None, max_depth: int = 30) -> Search:
    """Depth is not searched; 30 is the deepest tree Spark builds."""
    return Search("random_forest", RandomForestClassifier(seed=SEED, maxDepth=max_depth), grid or RANDOM_FOREST, "numTrees")


def full_search() -> list[Search]:
    """All 348 settings: 128 gradient boosting, 200 AdaBoost, 20 random forest, in 76 fits a fold."""
    return [gradient_boosting(), adaboost(), random_forest()]
