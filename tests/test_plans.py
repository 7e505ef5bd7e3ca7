"""The physical plans we count on at scale."""

import re
from dataclasses import fields

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from checks.queries import all_queries, features, user_totals
from tests.conftest import SAMPLES
from tidemark.operators import matrix, prep, sessions, subscriptions
from tidemark.sources import samples
from tidemark.sources.byuser import read_by_user, write_by_user
from tidemark.sources.tables import Dataset, read_table

FOLDER = f"{SAMPLES}/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"\bExchange (?:hash|range|single)", plan(df), flags=re.I))


def test_last_five_limits_rows_before_its_one_shuffle(spark):
    df = sessions.last_five_changes(samples.history_sessions(spark, FOLDER))
    text = plan(df)
    assert shuffles(df) == 1
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)
    assert "o_orderstatus" not in text.split("ReadSchema")[1].split("\n")[0]


def test_per_user_tables_join_without_another_shuffle(spark, tmp_path):
    path = str(tmp_path / "sessions")
    samples.play_sessions(spark, FOLDER).write.parquet(path)
    df = sessions.session_features(spark.read.parquet(path))
    assert shuffles(df) == 2


def test_churn_summary_shuffles_days_then_users(spark):
    df = subscriptions.churn_summary(samples.subscriptions(spark, FOLDER), 15)
    assert shuffles(df) == 2
    assert "SortAggregate" not in plan(df)


def test_age_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "demographics")
    samples.demographics(spark, FOLDER).write.parquet(path)
    rows = read_table(spark, "demographics", Dataset(path, format="parquet"))
    text = plan(prep.demographic_features(rows))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "LessThan(age,117)" in pushed and "GreaterThan(age,4)" in pushed
    assert "language" not in text.split("ReadSchema")[1]


@pytest.mark.parametrize("name", ["day_gap", "lpi_delta", "session_features", "game_matrix", "stratified_split"])
def test_no_python_and_no_pairing_in_the_plan(spark, name):
    text = plan(all_queries()[name](spark, FOLDER))
    for forbidden in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"):
        assert forbidden not in text


def test_tables_by_user_need_no_exchange(spark, tmp_path):
    paths = []
    for name, rows in (("a", samples.subscriptions(spark, FOLDER)), ("h", samples.history_sessions(spark, FOLDER))):
        paths.append(write_by_user(rows, str(tmp_path / name), 6, ["user_id", "date", "rid"], max_rows=20))
    activity, history = (read_by_user(spark, p) for p in paths)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(user_totals(activity, history))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text and text.count("Bucketed: true") == 2
    ordered = W.partitionBy("user_id").orderBy("date", "rid")
    assert "Exchange" not in plan(activity.select("user_id", F.lag("date").over(ordered)))
    # Users of more than 20 rows are in several files of that size, all others in one.
    assert activity.count() == samples.subscriptions(spark, FOLDER).count()
    assert activity.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 20


def test_matrix_and_funnel_read_each_table_once(spark, tmp_path):
    tables = features(spark, FOLDER)
    written = {}
    for field in fields(tables):
        getattr(tables, field.name).write.parquet(str(tmp_path / field.name))
        written[field.name] = spark.read.parquet(str(tmp_path / field.name))
    users = matrix.user_table(**written)
    assert plan(users).count("FileScan") == 4
    assert shuffles(users) == 1


def test_order_without_heavy_users_is_one_shuffle(spark):
    rows = samples.history_sessions(spark, FOLDER)
    light = sessions.lpi_deltas(rows)
    assert shuffles(light) == 1 and "Join" not in plan(light)
    heavy = sessions.lpi_deltas(rows, max_rows=5)
    assert "Join" in plan(heavy)
    assert sorted(map(str, light.collect())) == sorted(map(str, heavy.collect()))
    columns = {f.name: f.dataType for f in light.schema}
    assert columns == {f.name: f.dataType for f in heavy.schema}
