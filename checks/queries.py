"""Registered queries: one per operator, each over the whole sample tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import JobConfig
from tidemark.ml import grid, search, split
from tidemark.ml.adaboost import AdaBoostClassifier
from tidemark.ml.metrics import best_model, binary_metrics, score_auc
from tidemark.operators import gamemix, matrix, prep, sessions, subscriptions, variety
from tidemark.operators.matrix import feature_columns
from tidemark.operators.quantiles import impute_median
from tidemark.operators.sketches import daily_sketches, sketched_funnel
from tidemark.plans.jobs import FeatureTables, game_matrix_job, matrix_job
from tidemark.sources import samples
from tidemark.sources.byuser import read_by_user, write_by_user
from tidemark.sources.checked import Checked, read_checked
from tidemark.sources.tables import Dataset, read_back, read_table, write_table
from tidemark.storage import fresh_path, materialize

Query = Callable[[SparkSession, str], DataFrame]

CONFIG = JobConfig(churn_threshold=samples.SAMPLE_THRESHOLD)
AS_OF = dt.date(2024, 1, 20)
BUCKETS = 10
ROW_LIMIT = 100
GAMES = list(range(100))
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six digits: the order in which engines add doubles differs."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def features(spark: SparkSession, folder: str) -> FeatureTables:
    return FeatureTables(
        subscriptions=subscriptions.subscription_features(samples.subscriptions(spark, folder), CONFIG),
        sessions=sessions.session_features(samples.day_sessions(spark, folder), CONFIG),
        variety=variety.variety_features(samples.variety(spark, folder), CONFIG),
        demographics=prep.demographic_features(samples.demographics(spark, folder)),
    )


# --- activity and churn ---------------------------------------------------


@query
def churn_label(spark: SparkSession, folder: str) -> DataFrame:
    rows = samples.subscriptions(spark, folder)
    kept = subscriptions.churn_summary(rows, CONFIG.churn_threshold)
    return kept.select("user_id", "rid", "date", "day_gap", "churned")


@query
def day_gap(spark: SparkSession, folder: str) -> DataFrame:
    rows = samples.subscriptions(spark, folder).select("user_id", "rid", "date")
    return subscriptions.churn_flag(subscriptions.day_gap(rows), CONFIG.churn_threshold)


@query
def churn_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = samples.subscriptions(spark, folder)
    users = subscriptions.churn_summary(rows, CONFIG.churn_threshold)
    return users.select("user_id", F.col("churned").alias("ever_churned"), "churn_count", "prior_churn_count")


@query
def keep_one_row(spark: SparkSession, folder: str) -> DataFrame:
    """One row per user by priority, with order status as the flag."""
    rows = samples.subscriptions(spark, folder)
    flagged = rows.withColumn("churned", (F.col("state") == "free").cast("int"))
    return subscriptions.keep_one_row(flagged).select("user_id", "rid", "date", "churned")


@query
def subs_state_onehot(spark: SparkSession, folder: str) -> DataFrame:
    rows = subscriptions.state_flags(samples.subscriptions(spark, folder))
    return rows.select("user_id", "rid", "is_subs_acct", "is_free", "is_trial")


@query
def impute_median_subs(spark: SparkSession, folder: str) -> DataFrame:
    rows = samples.subscriptions(spark, folder)
    columns = ["workout_day", "gameplay_day", "day_gap"]
    kept = subscriptions.churn_summary(rows, CONFIG.churn_threshold, columns[:2])
    return impute_median(materialize(kept.select("user_id", *columns), "kept-rows"), columns)


@query
def impute_median_by_state(spark: SparkSession, folder: str) -> DataFrame:
    rows = samples.subscriptions(spark, folder).select("user_id", "rid", "state", "gameplay_day")
    return impute_median(rows, ["gameplay_day"], by="state")


@query
def subs_features(spark: SparkSession, folder: str) -> DataFrame:
    return subscriptions.subscription_features(samples.subscriptions(spark, folder), CONFIG)


# --- sessions -------------------------------------------------------------


@query
def lpi_first(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.first_lpi(samples.history_sessions(spark, folder))


@query
def lpi_delta(spark: SparkSession, folder: str) -> DataFrame:
    rows = sessions.lpi_deltas(samples.history_sessions(spark, folder))
    return rounded(rows.select("user_id", "rid", "delta"), "delta")


@query
def lpi_last5_list(spark: SparkSession, folder: str) -> DataFrame:
    """The list in cents, as text for comparison; '-' is a missing change."""
    rows = sessions.last_five_list(samples.history_sessions(spark, folder))
    cents = F.transform("last_5_deltas", lambda d: F.round(d * 100).cast("bigint").cast("string"))
    return rows.select("user_id", F.array_join(cents, " ", "-").alias("cents"))


@query
def lpi_last5_left(spark: SparkSession, folder: str) -> DataFrame:
    rows = sessions.last_five_changes(samples.history_sessions(spark, folder), "left")
    return rounded(rows, *sessions.CHANGE_COLUMNS)


@query
def lpi_last5_right(spark: SparkSession, folder: str) -> DataFrame:
    rows = sessions.last_five_changes(samples.history_sessions(spark, folder), "right")
    return rounded(rows, *sessions.CHANGE_COLUMNS)


@query
def lpi_impute_median(spark: SparkSession, folder: str) -> DataFrame:
    rows = samples.history_sessions(spark, folder).select("user_id", "rid", "lpi")
    return rounded(impute_median(rows, ["lpi"]), "lpi")


@query
def session_length_avg(spark: SparkSession, folder: str) -> DataFrame:
    rows = sessions.session_length(samples.day_sessions(spark, folder))
    return rounded(rows, "length_of_session_avgs")


@query
def hour_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sessions.hour_stats(samples.day_sessions(spark, folder)), "hour_avg", "hour_std")


@query
def user_games_in_order(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.games_in_order(samples.play_sessions(spark, folder))


@query
def event_value_delta(spark: SparkSession, folder: str) -> DataFrame:
    """Changes along timestamps, with slices of about 20 rows so that every user is cut."""
    rows = samples.event_values(spark, folder)
    return sessions.lpi_deltas(rows, max_rows=20).select("user_id", "rid", F.round("delta", 6).alias("delta"))


@query
def user_games_string(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.games_string(samples.play_sessions(spark, folder), max_sessions=10_000)


@query
def session_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = sessions.session_features(samples.day_sessions(spark, folder), CONFIG)
    return rounded(rows, *[c for c in rows.columns if c != "user_id"])


# --- weekly variety -------------------------------------------------------

_GV = ("gv_max", "gv_avg", "gv_std_dev")


@query
def variety_poison(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(variety.variety_stats(samples.variety(spark, folder), "poison"), *_GV)


@query
def variety_skip(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(variety.variety_stats(samples.variety(spark, folder), "skip"), *_GV)


@query
def variety_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(variety.variety_features(samples.variety(spark, folder), CONFIG), *_GV)


@query
def variety_no_future_weeks(spark: SparkSession, folder: str) -> DataFrame:
    config = JobConfig(as_of=AS_OF)
    return rounded(variety.variety_features(samples.variety(spark, folder), config), *_GV)


# --- demographics, rows, buckets ------------------------------------------


@query
def demo_onehot(spark: SparkSession, folder: str) -> DataFrame:
    return prep.gender_flag(samples.demographics(spark, folder)).select("user_id", "is_male")


@query
def demo_age_filter(spark: SparkSession, folder: str) -> DataFrame:
    return prep.believable_age(samples.demographics(spark, folder))


@query
def demo_features(spark: SparkSession, folder: str) -> DataFrame:
    return prep.demographic_features(samples.demographics(spark, folder))


@query
def dedupe_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.read.parquet(f"{folder}/events.parquet")
    return prep.distinct_rows(events.select("user_id", F.to_date("ts").alias("date"), "event_type"))


@query
def row_limit(spark: SparkSession, folder: str) -> DataFrame:
    rows = samples.subscriptions(spark, folder)
    return prep.first_rows(rows, ["user_id", "date", "rid"], ROW_LIMIT).select("user_id", "date", "rid")


@query
def user_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return prep.bucket_sizes(samples.subscriptions(spark, folder), BUCKETS)


# --- games ----------------------------------------------------------------


@query
def game_counts(spark: SparkSession, folder: str) -> DataFrame:
    return gamemix.game_counts(samples.plays(spark, folder))


@query
def game_totals(spark: SparkSession, folder: str) -> DataFrame:
    return gamemix.game_totals(samples.plays(spark, folder))


@query
def game_proportions(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(gamemix.game_proportions(samples.plays(spark, folder)), "proportion")


@query
def game_matrix(spark: SparkSession, folder: str) -> DataFrame:
    wide = gamemix.game_matrix(samples.plays(spark, folder), GAMES)
    return rounded(wide, *[f"game_{g}" for g in GAMES])


@query
def game_index(spark: SparkSession, folder: str) -> DataFrame:
    return gamemix.game_index(samples.plays(spark, folder))


@query
def indexed_game_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Sparse vectors by dense index, written out as text for comparison."""
    plays = samples.plays(spark, folder)
    rows = gamemix.sparse_vectors(plays, gamemix.game_index(plays))
    return gamemix.vector_entries(rows).select(
        "user_id",
        "size",
        F.array_join(F.col("indices").cast("array<string>"), " ").alias("places"),
        F.array_join(F.transform("values", lambda x: F.round(x * 1_000_000).cast("bigint").cast("string")), " ").alias("millionths"),
    )


@query
def game_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Sparse rows, written out as text for comparison."""
    rows = gamemix.game_vectors(samples.plays(spark, folder))
    entry = F.transform(
        F.map_entries("proportions"),
        lambda e: F.concat_ws(":", e["key"].cast("string"), F.round(e["value"] * 1_000_000).cast("bigint").cast("string")),
    )
    return rows.select("user_id", F.array_join(entry, " ").alias("millionths"))


# --- matrix ---------------------------------------------------------------


@query
def join_funnel(spark: SparkSession, folder: str) -> DataFrame:
    return features(spark, folder).funnel()


@query
def matrix_job_funnel(spark: SparkSession, folder: str) -> DataFrame:
    """The funnel as the matrix job leaves it, without a pass of its own."""
    return features(spark, folder).matrix_and_funnel()[1]


@query
def matrix_job_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The matrix from the same table of users as its funnel."""
    return _rounded_matrix(features(spark, folder).matrix_and_funnel()[0])


@query
def data_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_matrix(features(spark, folder).matrix())


def _rounded_matrix(rows: DataFrame) -> DataFrame:
    exact = {"user_id", "churned", "prior_churn_count", "age", "is_male"}
    return rounded(rows, *[c for c in rows.columns if c not in exact])


@query
def assembled_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Label and feature vector, the vector as its length, sum and ten-thousandths in order."""
    rows = matrix.assemble(features(spark, folder).matrix())
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    parts = F.array_join(F.transform(values, lambda x: F.round(x * 10_000).cast("bigint").cast("string")), " ")
    return rows.select(
        "user_id",
        F.col("label").cast("int").alias("label"),
        F.size(values).alias("n"),
        F.round(total, 4).alias("total"),
        parts.alias("parts"),
    )


# --- files ----------------------------------------------------------------


@query
def row_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Positions in a table of several text files, each cut into many tasks."""
    rows = samples.subscriptions(spark, folder).withColumnRenamed("rid", "order_id")
    path = fresh_path(spark, "ordered-files")
    files = rows.repartitionByRange(4, "order_id").sortWithinPartitions("order_id")
    files.write.option("header", True).csv(path)
    numbered = read_table(spark, "subscriptions", Dataset(path))
    return numbered.select("user_id", F.col("order_id").cast("bigint").alias("order_id"), F.col("rid").alias("position"))


@query
def tables_by_user(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables stored by user, each reduced per user and joined."""
    order = ["user_id", "date", "rid"]
    activity = write_by_user(samples.subscriptions(spark, folder), fresh_path(spark, "activity"), BUCKETS, order)
    history = write_by_user(samples.history_sessions(spark, folder), fresh_path(spark, "history"), BUCKETS, order)
    return user_totals(read_by_user(spark, activity), read_by_user(spark, history))


def user_totals(activity: DataFrame, history: DataFrame) -> DataFrame:
    days = activity.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max("date").alias("last_date"))
    best = history.groupBy("user_id").agg(F.max("lpi").alias("best_lpi"))
    return days.join(best, "user_id")


@query
def tsv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = samples.subscriptions(spark, folder)
    path = write_table(rows, fresh_path(spark, "subscriptions-tsv"))
    return read_back(spark, path, rows.schema)


@query
def tsv_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with line breaks, blanks, quotes, empty and missing values through text files."""
    rows = samples.texts(spark, folder)
    path = write_table(rows, fresh_path(spark, "texts-tsv"))
    return read_back(spark, path, rows.schema)


@query
def union_files(spark: SparkSession, folder: str) -> DataFrame:
    """Two files of one table with their columns in different orders, put together by name."""
    rows = samples.demographics(spark, folder)
    odd = F.col("user_id") % 2 == 1
    parts = [
        rows.where(odd),
        rows.where(~odd).select("language", "age", F.col("user_id").alias("userId"), "gender"),
    ]
    paths = []
    for i, part in enumerate(parts):
        paths.append(fresh_path(spark, f"part-{i}"))
        part.write.option("header", True).csv(paths[-1])
    both = read_table(spark, "demographics", Dataset(tuple(paths)))
    return both.select("user_id", F.col("age").cast("int").alias("age"), "gender", "language")


@query
def matrix_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """The whole matrix job from tab-separated files, with its intermediates written."""
    tables = {
        "demographics": samples.demographics(spark, folder),
        "sessions": samples.play_sessions(spark, folder),
        "variety": samples.variety(spark, folder).withColumn("lpi", F.lit(None).cast("double")),
        "subscriptions": samples.subscriptions(spark, folder),
    }
    registry = {
        name: Dataset(write_table(df, fresh_path(spark, name)), separator="\t", row_id="rid" if "rid" in df.columns else None)
        for name, df in tables.items()
    }
    config = JobConfig(churn_threshold=samples.SAMPLE_THRESHOLD, intermediates=fresh_path(spark, "intermediates"))
    return _rounded_matrix(matrix_job(spark, registry, config))


def _with_defects(spark: SparkSession, folder: str) -> Checked:
    """Activity rows as text, some without a user, with a day that is none, or with words for numbers."""
    rows = samples.subscriptions(spark, folder)
    rid = F.col("rid")
    broken = rows.select(
        F.when(rid % 17 != 0, F.col("user_id")).alias("user_id"),
        F.when(rid % 11 == 0, "soon").otherwise(F.col("date").cast("string")).alias("date"),
        "state",
        F.when(rid % 13 == 0, F.concat(F.lit("day "), "workout_day")).otherwise(F.col("workout_day").cast("string")).alias("workout_day"),
        F.when(rid % 19 == 0, "2.5").otherwise(F.concat("gameplay_day", F.lit(".0"))).alias("gameplay_day"),
        "rid",
    )
    path = fresh_path(spark, "defects")
    broken.write.option("header", True).csv(path)
    return read_checked(spark, "subscriptions", Dataset(path, row_id="rid"))


@query
def good_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _with_defects(spark, folder).good


@query
def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    rejected = _with_defects(spark, folder).rejected
    rid = F.get_json_object("raw", "$.rid").cast("bigint")
    return rejected.select(rid.alias("rid"), F.array_join("reasons", "; ").alias("reasons"))


@query
def funnel_from_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Users of the raw tables in a span of days, from a stored sketch per table and day."""
    tables = [
        daily_sketches(samples.subscriptions(spark, folder), "subs", "date"),
        daily_sketches(samples.plays(spark, folder), "sessions", "at"),
        daily_sketches(samples.event_values(spark, folder), "variety", "date"),
        daily_sketches(samples.demographics(spark, folder), "demographics"),
    ]
    stored = materialize(reduce(DataFrame.unionAll, tables), "sketches")
    return sketched_funnel(stored, "1995-01-01", "2024-01-10")


@query
def games_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """The game matrix job from a comma-separated file of sessions, games all of the catalogue."""
    path = fresh_path(spark, "sessions-csv")
    samples.play_sessions(spark, folder).write.option("header", True).csv(path)
    config = JobConfig(intermediates=fresh_path(spark, "intermediates"), intermediates_format="parquet")
    wide = game_matrix_job(spark, {"sessions": Dataset(path, row_id="rid")}, GAMES, config)
    return rounded(wide, *[f"game_{g}" for g in GAMES])


# --- splits and metrics ---------------------------------------------------


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return churn_label(spark, folder).select("user_id", "churned")


@query
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return split.stratified_split(_labels(spark, folder), "churned")


@query
def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    return split.stratified_folds(_labels(spark, folder), "churned")


@query
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    return split.hash_split(_labels(spark, folder))


def _rule_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Three rules as models: few orders, always, never."""
    rows = samples.subscriptions(spark, folder)
    orders = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("orders"))
    facts = _labels(spark, folder).join(orders, "user_id")
    rules = F.array(
        F.struct(F.lit("few_orders").alias("model"), (F.col("orders") < 9).cast("int").alias("prediction")),
        F.struct(F.lit("always").alias("model"), F.lit(1).alias("prediction")),
        F.struct(F.lit("never").alias("model"), F.lit(0).alias("prediction")),
    )
    return facts.select(F.col("churned").alias("label"), F.inline(rules))


_SCORES = ("precision", "recall", "accuracy", "auc", "mse")


@query
def binary_metrics_of_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(binary_metrics(_rule_predictions(spark, folder)), *_SCORES)


@query
def best_rule(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(best_model(binary_metrics(_rule_predictions(spark, folder)), "recall"), *_SCORES)


@query
def score_auc_of_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Areas under scores with many ties: a user's orders and months, and one score for all."""
    rows = samples.subscriptions(spark, folder)
    facts = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("orders"), F.max("gameplay_day").alias("latest"))
    scores = F.array(
        F.struct(F.lit("few_orders").alias("model"), (-F.col("orders")).cast("double").alias("score")),
        F.struct(F.lit("late_month").alias("model"), F.col("latest").cast("double").alias("score")),
        F.struct(F.lit("same").alias("model"), F.lit(0.5).alias("score")),
    )
    scored = _labels(spark, folder).join(facts, "user_id").select(F.col("churned").alias("label"), F.inline(scores))
    return rounded(score_auc(scored), "score_auc")


# --- models on the matrix -------------------------------------------------


def _search() -> list[grid.Search]:
    """Settings of the published grids, the smaller tree counts and one value of all else."""
    return [
        grid.gradient_boosting({"maxDepth": [2], "maxIter": [50, 75], "stepSize": [0.5], "featureSubsetStrategy": ["sqrt"]}),
        grid.adaboost({"maxDepth": [2], "maxIter": [50], "learningRate": [0.5], "featureSubsetStrategy": ["sqrt"]}),
        grid.random_forest({"numTrees": [50, 100], "featureSubsetStrategy": ["sqrt", "log2"], "minInstancesPerNode": [2]}),
    ]


def _split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, list[str]]:
    rows = features(spark, folder).matrix()
    train, test = search.split_matrix(rows)
    return train, test, feature_columns(rows)


def _scored(spark: SparkSession, folder: str, name: str, estimator) -> DataFrame:
    train, test, _ = _split(spark, folder)
    return rounded(search.predict_and_score({name: estimator.fit(train)}, test), *_SCORES)


@query
def gbt_scores(spark: SparkSession, folder: str) -> DataFrame:
    chosen = grid.gradient_boosting().estimator.copy().setMaxIter(50).setMaxDepth(2)
    return _scored(spark, folder, "gradient_boosting", chosen)


@query
def rf_scores(spark: SparkSession, folder: str) -> DataFrame:
    chosen = grid.random_forest(max_depth=6).estimator.copy().setNumTrees(50)
    return _scored(spark, folder, "random_forest", chosen)


@query
def adaboost_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, "adaboost", AdaBoostClassifier(maxIter=50, maxDepth=2))


def _stump_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Free or not, and three whole-number features of few values, so that Spark's bins hold all of them."""
    rows = samples.subscriptions(spark, folder)
    kept = subscriptions.churn_summary(rows, CONFIG.churn_threshold, ["workout_day", "gameplay_day", "state"])
    people = prep.gender_flag(samples.demographics(spark, folder)).select("user_id", "is_male")
    free = (F.col("state") == "free").cast("int")
    facts = kept.join(people, "user_id").select(
        "user_id", free.alias("free"), "workout_day", F.coalesce("gameplay_day", F.lit(0)).alias("gameplay_day"), "is_male"
    )
    return materialize(matrix.assemble(facts, label="free"), "facts")


@query
def stump_scores(spark: SparkSession, folder: str) -> DataFrame:
    """One split by each classifier: a boosted margin, a forest's probability, a weighted vote."""
    rows = _stump_facts(spark, folder)
    boosted = GBTClassifier(maxIter=1, maxDepth=1, seed=grid.SEED).fit(rows)
    forest = RandomForestClassifier(numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", seed=grid.SEED).fit(rows)
    voted = AdaBoostClassifier(maxIter=1, maxDepth=1, featureSubsetStrategy="all").fit(rows)
    scored = boosted.transform(rows).select("user_id", "features", vector_to_array("rawPrediction")[1].alias("margin"))
    scored = forest.transform(scored).select("user_id", "features", "margin", vector_to_array("probability")[1].alias("share"))
    scored = voted.transform(scored).select("user_id", "margin", "share", F.col("rawScore").alias("vote"))
    return rounded(scored, "margin", "share", "vote")


@query
def logit_gradient(spark: SparkSession, folder: str) -> DataFrame:
    """The penalised loss is flat at the fitted coefficients."""
    train, _, names = _split(spark, folder)
    slopes = search.logistic_gradient(search.fit_logistic(train, 1e-12, 1000), train, names)
    # Adding zero takes the sign off a rounded -0.0.
    return slopes.select("item", (F.round("gradient", 1) + F.lit(0.0)).alias("gradient"))


@query
def logit_report(spark: SparkSession, folder: str) -> DataFrame:
    train, test, names = _split(spark, folder)
    return rounded(search.logistic_report(spark, train, test, names), "value")


@query
def grid_report(spark: SparkSession, folder: str) -> DataFrame:
    train, _, _ = _split(spark, folder)
    results = search.fit_grid_search(train, _search())
    report = search.grid_report(spark, results)
    settings = F.array_sort(F.transform(F.map_entries("params"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return rounded(report.withColumn("params", F.array_join(settings, " ")), "avg_score")


@query
def best_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The whole training job; its best model's scores on the test users."""
    rows = features(spark, folder).matrix()
    outcome = search.train_and_evaluate(spark, rows, _search())
    return rounded(outcome.scores.where(F.col("model") == outcome.best_name), *_SCORES)


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)
