import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks.compare import difference
from checks.queries import all_queries
from tests.conftest import SAMPLES
from tidemark.sources import samples

ORACLES = contract.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())
    assert contract.queries().keys() >= all_queries().keys()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["user_id", "rid", "date", "day_gap", "churned"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    problem, rows, _ = difference(spark, f"{SAMPLES}/sf0.001", name)
    assert problem is None and rows > 0


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """User 7 holds half of all rows, most of them on one day."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    n = 60_000
    pick = F.pmod(F.xxhash64("id"), F.lit(10))
    user = F.when(pick < 5, F.lit(7)).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(80)))
    spread = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(20 * 86400))
    one_day = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(86400))
    second = F.when((pick < 5) & (pick > 0), one_day).otherwise(spread)
    ts = F.timestamp_micros((F.lit(1704067200) + second) * 1_000_000).cast("timestamp_ntz")
    kinds = F.array(*[F.lit(k) for k in ("view", "error", "purchase", "signup", "click")])
    kind = F.element_at(kinds, (F.pmod(F.xxhash64("id", F.lit(4)), F.lit(5)) + 1).cast("int"))
    spark.range(n).select(
        F.col("id").alias("event_id"), ts.alias("ts"), user.cast("bigint").alias("user_id"), kind.alias("event_type"),
        (F.pmod(F.xxhash64("id", F.lit(5)), F.lit(4000)) / 100).alias("value"),
        F.concat(F.lit('{"k": '), F.pmod(F.xxhash64("id", F.lit(6)), F.lit(100)).cast("string"), F.lit("}")).alias("props"),
    ).coalesce(1).write.parquet(f"{folder}/raw/events.parquet")
    for name in ("orders", "customer"):
        spark.read.parquet(f"{SAMPLES}/sf0.01/{name}.parquet").coalesce(1).write.parquet(f"{folder}/raw/{name}.parquet")
    # One file per table, as in the samples.
    from pathlib import Path

    flat = Path(folder) / "flat"
    flat.mkdir()
    for table in Path(folder, "raw").iterdir():
        part = next(table.glob("part-*.parquet"))
        (flat / table.name).write_bytes(part.read_bytes())
    return str(flat)


@pytest.mark.parametrize(
    "name",
    [
        "session_features", "session_length_avg", "user_games_string", "game_proportions", "game_totals", "variety_poison",
        "dedupe_rows", "join_funnel",
    ],
)
def test_query_equals_sql_when_one_user_holds_half(spark, skewed, name):
    problem, rows, _ = difference(spark, skewed, name)
    assert problem is None and rows > 0


@pytest.mark.parametrize("sessions", [samples.day_sessions, samples.play_sessions])
def test_one_session_per_user_and_day(spark, skewed, sessions):
    """Whatever the number of events: of a day, or of the table."""
    rows = sessions(spark, skewed)
    days = spark.read.parquet(f"{skewed}/events.parquet").select("user_id", F.to_date("ts")).distinct().count()
    assert rows.count() == rows.select("user_id", "date").distinct().count() == days


def test_sessions_at_scale(spark):
    assert samples.day_sessions(spark, f"{SAMPLES}/sf0.1").count() == 40_083


def test_a_hot_day_is_folded_before_the_shuffle(spark, skewed):
    text = samples.day_sessions(spark, skewed)._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate") >= 2 and "SortAggregate" not in text and "collect" not in text


MODEL_QUERIES = ["gbt_scores", "rf_scores", "adaboost_scores", "logit_report", "grid_report", "best_model_scores"]


def test_only_the_model_queries_have_no_sql():
    assert set(all_queries()) - set(ORACLES) == set(MODEL_QUERIES)


# grid_report's steps are all part of best_model_scores.
@pytest.mark.parametrize("name", [n for n in MODEL_QUERIES if n != "grid_report"])
def test_model_queries_run(spark, name):
    assert all_queries()[name](spark, f"{SAMPLES}/sf0.01").collect()
