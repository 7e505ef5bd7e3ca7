"""The whole job from files to scored models, for spark-submit.

    spark-submit tidemark/plans/train.py tables.json --threshold 15 --search full

`tables.json` maps each logical table to the fields of a Dataset:
{"sessions": {"path": "s3a://…", "format": "csv", "row_id": "seq"}, …}. It is
read through Spark, so it may lie on any file system the cluster knows.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tidemark.config import JobConfig
from tidemark.ml import grid, search
from tidemark.plans.jobs import all_features, keep_intermediate
from tidemark.sources.tables import SCHEMAS, Dataset

# A trial run: one mid-grid setting per classifier.
QUICK = {
    "gradient_boosting": {"stepSize": [0.2], "maxDepth": [4], "maxIter": [50]},
    "adaboost": {"learningRate": [0.5], "maxDepth": [2], "maxIter": [50]},
    "random_forest": {"numTrees": [100]},
}


def read_registry(spark: SparkSession, path: str) -> dict[str, Dataset]:
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    registry = {name: Dataset(**fields) for name, fields in json.loads(text).items()}
    missing = sorted(set(SCHEMAS) - set(registry))
    if missing:
        raise ValueError(f"{path} lacks tables {missing}")
    return registry


def searches(kind: str) -> list[grid.Search]:
    if kind == "full":
        return grid.full_search()
    return [
        grid.gradient_boosting(QUICK["gradient_boosting"]),
        grid.adaboost(QUICK["adaboost"]),
        grid.random_forest(QUICK["random_forest"], max_depth=10),
    ]


def run(
    spark: SparkSession,
    registry: dict[str, Dataset],
    config: JobConfig,
    chosen: list[grid.Search],
    metric: str = "recall",
    parallelism: int = 2,
) -> search.Evaluation:
    """Features, funnel, matrix, search and scores; prints the reports."""
    matrix, funnel = all_features(spark, registry, config).matrix_and_funnel()
    funnel.orderBy("step").show()
    matrix = keep_intermediate(spark, registry, "matrix", config, lambda rows=matrix: rows, list(SCHEMAS))
    outcome = search.train_and_evaluate(spark, matrix, chosen, metric, parallelism=parallelism)
    outcome.report.where("rank = 1").show(truncate=False)
    outcome.scores.show()
    print(f"best model by {metric}: {outcome.best_name}")
    return outcome


def main(argv: list[str] | None = None) -> search.Evaluation:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("tables", help="JSON file naming the four datasets")
    parser.add_argument("--threshold", type=int, default=15, help="days of inactivity that count as churn")
    parser.add_argument("--row-limit", type=int, help="read only the first rows of each dataset")
    parser.add_argument("--intermediates", help="folder for the per-user tables")
    parser.add_argument("--search", choices=["quick", "full"], default="full")
    parser.add_argument("--metric", choices=["recall", "precision", "accuracy"], default="recall")
    parser.add_argument("--parallelism", type=int, default=2, help="models fitted at a time")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    config = JobConfig(
        churn_threshold=args.threshold, row_limit=args.row_limit, intermediates=args.intermediates
    )
    registry = read_registry(spark, args.tables)
    return run(spark, registry, config, searches(args.search), args.metric, args.parallelism)


if __name__ == "__main__":
    main()
