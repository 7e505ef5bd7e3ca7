"""The composed jobs: four feature tables, the matrix, the game matrix, training.

Every job takes a registry (logical table -> Dataset) and a JobConfig. With a folder
in ``config.intermediates`` each table is written there once and later steps read the
files, as do later runs with the same options and input files. Without one the jobs are lazy, except that subscription features write their
per-user table to the shared folder before they take medians of it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import JobConfig
from tidemark.operators import gamemix, matrix, prep, sessions, subscriptions, variety
from tidemark.plans import restart
from tidemark.sources.tables import SCHEMAS, Dataset, load

Registry = Mapping[str, Dataset]
from tidemark.storage import materialize

# Table names of the written intermediates.
INTERMEDIATES = {
    "demographics": "intermed_demograph",
    "sessions": "intermed_gameid",
    "variety": "intermed_gamevar",
    "subscriptions": "intermed_subs",
    "matrix": "final_matrix",
    "game_matrix": "knn_matrix",
}


def keep_intermediate(
    spark: SparkSession,
    registry: Registry,
    table: str,
    config: JobConfig,
    build: Callable[[], DataFrame],
    inputs: Sequence[str] | None = None,
    chosen: Mapping[str, object] | None = None,
) -> DataFrame:
    """`build()`, or with a folder for intermediates the files of it, written unless a run before has done so.

    `inputs` are the registered tables that it depends on, by default the one of its own name, and
    `chosen` further options.
    """
    if config.intermediates is None:
        return build()
    folder = f"{config.intermediates.rstrip('/')}/{INTERMEDIATES[table]}"
    used = {name: registry[name] for name in inputs or [table] if name in registry}
    mark = restart.fingerprint(spark, table, config, used, chosen)
    return restart.keep(spark, folder, mark, build, config.intermediates_format)[0]


def demographics_job(spark: SparkSession, registry: Registry, config: JobConfig = JobConfig()) -> DataFrame:
    def build() -> DataFrame:
        return prep.demographic_features(load(spark, registry, "demographics", config.row_limit))

    return keep_intermediate(spark, registry, "demographics", config, build)


def sessions_job(spark: SparkSession, registry: Registry, config: JobConfig = JobConfig()) -> DataFrame:
    def build() -> DataFrame:
        return sessions.session_features(load(spark, registry, "sessions", config.row_limit), config)

    return keep_intermediate(spark, registry, "sessions", config, build)


def variety_job(spark: SparkSession, registry: Registry, config: JobConfig = JobConfig()) -> DataFrame:
    def build() -> DataFrame:
        return variety.variety_features(load(spark, registry, "variety", config.row_limit), config)

    return keep_intermediate(spark, registry, "variety", config, build)


def subscriptions_job(spark: SparkSession, registry: Registry, config: JobConfig = JobConfig()) -> DataFrame:
    def build() -> DataFrame:
        return subscriptions.subscription_features(load(spark, registry, "subscriptions", config.row_limit), config)

    return keep_intermediate(spark, registry, "subscriptions", config, build)


@dataclass(frozen=True)
class FeatureTables:
    """The four per-user tables, in join order."""

    subscriptions: DataFrame
    sessions: DataFrame
    variety: DataFrame
    demographics: DataFrame

    def matrix(self) -> DataFrame:
        return matrix.data_matrix(self.subscriptions, self.sessions, self.variety, self.demographics)

    def funnel(self) -> DataFrame:
        return matrix.join_funnel(self.subscriptions, self.sessions, self.variety, self.demographics)

    def matrix_and_funnel(self) -> tuple[DataFrame, DataFrame]:
        """Both from one written table of users, so that each of the four tables is computed once."""
        users = matrix.user_table(self.subscriptions, self.sessions, self.variety, self.demographics)
        users = materialize(users, "users")
        return matrix.matrix_of_users(users), matrix.funnel_of_users(users)


def all_features(spark: SparkSession, registry: Registry, config: JobConfig = JobConfig()) -> FeatureTables:
    return FeatureTables(
        subscriptions=subscriptions_job(spark, registry, config),
        sessions=sessions_job(spark, registry, config),
        variety=variety_job(spark, registry, config),
        demographics=demographics_job(spark, registry, config),
    )


def matrix_job(spark: SparkSession, registry: Registry, config: JobConfig = JobConfig()) -> DataFrame:
    def build() -> DataFrame:
        return all_features(spark, registry, config).matrix()

    return keep_intermediate(spark, registry, "matrix", config, build, list(SCHEMAS))


def game_matrix_job(
    spark: SparkSession,
    registry: Registry,
    games: Sequence[int] | None = None,
    config: JobConfig = JobConfig(),
    values: Sequence[str] = ("proportion",),
) -> DataFrame:
    def build() -> DataFrame:
        return gamemix.game_matrix(load(spark, registry, "sessions", config.row_limit), games, values)

    chosen = {"games": None if games is None else list(games), "values": list(values)}
    return keep_intermediate(spark, registry, "game_matrix", config, build, ["sessions"], chosen)
