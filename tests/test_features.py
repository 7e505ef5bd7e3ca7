import datetime as dt
from functools import reduce

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import SparseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tests.conftest import by_user
from tidemark.config import JobConfig
from tidemark.operators import gamemix, matrix, prep, sketches, variety

GV = ("gv_max", "gv_avg", "gv_std_dev")


def weeks(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, weekOfYear int, gameVariety double")


@pytest.mark.parametrize("policy,second", [("poison", (0, 0, 0)), ("skip", (3, 3, 0))])
def test_variety(spark, policy, second):
    df = weeks(spark, [(1, 1, 1.0), (1, 2, 2.0), (1, 3, 4.0), (2, 1, 3.0), (2, 2, None), (3, 1, None)])
    got = by_user(variety.variety_stats(df, policy), *GV)
    assert got[1] == pytest.approx((4, 2.333333, 1.247219), abs=1e-6)
    assert got[2] == second
    assert got[3] == (0, 0, 0)


def test_future_weeks_go_only_with_a_date(spark):
    df = weeks(spark, [(1, 1, 1.0), (1, 50, 9.0)])
    assert by_user(variety.variety_features(df), "gv_max")[1] == (9.0,)
    # 2024-12-30 is in ISO week 1.
    config = JobConfig(as_of=dt.date(2024, 12, 30))
    assert by_user(variety.variety_features(df, config), "gv_max")[1] == (1.0,)


def test_demographics(spark):
    rows = [(1, 4, "m"), (2, 5, "m"), (3, 116, "f"), (4, 117, "f"), (5, None, "m"), (6, 30, None), (None, 30, "m")]
    df = spark.createDataFrame(rows, "user_id bigint, age int, gender string").selectExpr("*", "'en' AS language")
    got = prep.demographic_features(df)
    assert got.columns == ["user_id", "age", "is_male"]
    assert by_user(got, "age", "is_male") == {2: (5, 1), 3: (116, 0), 6: (30, 0)}


def test_a_missing_gender_keeps_the_schema(spark):
    df = spark.createDataFrame([(1, 20, "f")], "user_id bigint, age int, gender string")
    assert by_user(prep.gender_flag(df), "is_male") == {1: (0,)}


def test_distinct_rows_and_row_limit(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (0, "z")], "user_id bigint, v string")
    assert prep.distinct_rows(df).count() == 3
    assert [r.user_id for r in prep.first_rows(df, ["user_id", "v"], 2).collect()] == [0, 1]


def test_no_user_spans_buckets(spark):
    df = spark.range(1000).selectExpr("id % 50 AS user_id", "id AS rid").repartition(7)
    placed = prep.user_bucket(df, 10).select("user_id", "bucket").distinct()
    assert placed.count() == 50
    sizes = prep.bucket_sizes(df, 10).collect()
    assert sum(r.n_rows for r in sizes) == 1000 and sum(r.n_users for r in sizes) == 50
    parts = prep.partition_by_user(df, 5).selectExpr("user_id", "spark_partition_id() AS p").distinct()
    assert parts.count() == 50


GAMES = [(1, "1,2"), (1, "2"), (2, "3"), (None, "4")]


def games(spark):
    return spark.createDataFrame(GAMES, "user_id bigint, gameId string")


def test_game_proportions(spark):
    got = {(r.user_id, r.game_id): (r.plays, r.total_plays, r.proportion) for r in gamemix.game_proportions(games(spark)).collect()}
    assert got == {
        (1, 1): (1, 3, pytest.approx(1 / 3)),
        (1, 2): (2, 3, pytest.approx(2 / 3)),
        (2, 3): (1, 1, 1.0),
    }
    assert by_user(gamemix.game_totals(games(spark)), "total_plays") == {1: (3,), 2: (1,)}


def test_game_matrix(spark):
    wide = gamemix.game_matrix(games(spark), [1, 2, 3])
    assert wide.columns == ["user_id", "game_1", "game_2", "game_3"]
    got = by_user(wide, "game_1", "game_2", "game_3")
    assert got == {1: (pytest.approx(1 / 3), pytest.approx(2 / 3), 0.0), 2: (0.0, 0.0, 1.0)}


def test_game_matrix_blocks(spark):
    wide = gamemix.game_matrix(games(spark), [2, 9], ["plays", "total_plays"], unlisted="drop")
    assert set(wide.columns) == {"user_id", "plays_2", "plays_9", "total_plays_2", "total_plays_9"}
    assert by_user(wide, "plays_2", "plays_9", "total_plays_2", "total_plays_9") == {1: (2, 0, 3, 0), 2: (0, 0, 0, 0)}
    single = gamemix.game_matrix(games(spark), [2], ["plays"], unlisted="drop")
    assert single.columns == ["user_id", "plays_2"]


def test_game_vectors(spark):
    got = by_user(gamemix.game_vectors(games(spark)), "proportions")
    assert got[1][0] == {1: pytest.approx(1 / 3), 2: pytest.approx(2 / 3)}


def tables(spark):
    subs = spark.createDataFrame([(1, 1.0, 1), (2, 2.0, 0), (3, 3.0, 0)], "user_id bigint, workout_day double, churned int")
    sess = spark.createDataFrame([(1, 5.0), (2, 6.0), (9, 7.0)], "user_id bigint, hour_avg double")
    var = spark.createDataFrame([(2, 1.0), (1, 1.0)], "user_id bigint, gv_max double")
    demo = spark.createDataFrame([(1, 30), (7, 31)], "user_id bigint, age int")
    return subs, sess, var, demo


def test_users_meet_by_id_not_by_position(spark):
    got = matrix.data_matrix(*tables(spark))
    assert got.columns == ["user_id", "workout_day", "churned", "hour_avg", "gv_max", "age"]
    assert [tuple(r) for r in got.collect()] == [(1, 1.0, 1, 5.0, 1.0, 30)]


def test_funnel(spark):
    got = {(r.step, r.side): r.users for r in matrix.join_funnel(*tables(spark)).collect()}
    assert got == {
        (1, "subs"): 3,
        (1, "sessions"): 3,
        (2, "matrix"): 2,
        (2, "variety"): 2,
        (3, "matrix"): 2,
        (3, "demographics"): 2,
        (4, "matrix"): 1,
    }


def test_repeated_users_are_found(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "user_id bigint")
    assert [tuple(r) for r in matrix.repeated_users(df).collect()] == [(1, 2)]


def test_assemble_refuses_missing_features(spark):
    good = matrix.assemble(matrix.data_matrix(*tables(spark)))
    row = good.first()
    assert (row.user_id, row.label, list(row.features)) == (1, 1.0, [1.0, 5.0, 1.0, 30.0])
    bad = spark.createDataFrame([(1, None, 0)], "user_id bigint, x double, churned int")
    with pytest.raises(Exception):
        matrix.assemble(bad).collect()




def test_matrix_over_all_games_and_unlisted_ones(spark):
    assert gamemix.game_matrix(games(spark)).columns == ["user_id", "game_1", "game_2", "game_3"]
    with pytest.raises(Exception, match="not listed"):
        gamemix.game_matrix(games(spark), [1, 2]).collect()


def test_a_user_listed_twice_is_an_error(spark):
    subs, sess, variety, demo = tables(spark)
    assert matrix.data_matrix(subs, sess, variety, demo).count() > 0
    with pytest.raises(Exception, match="more than one row"):
        matrix.data_matrix(subs, sess, variety, demo.unionByName(demo)).collect()


def test_other_demographics_columns_are_named_to_stay(spark):
    df = spark.createDataFrame([(1, 20, "m", "en", "x")], "user_id bigint, age int, gender string, language string, note string")
    assert prep.demographic_features(df).columns == ["user_id", "age", "is_male"]
    assert prep.demographic_features(df, ["note"]).columns == ["user_id", "age", "is_male", "note"]


def test_sparse_vectors_feed_pyspark_ml(spark):
    plays = spark.range(4000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 50 END AS user_id", "cast(pmod(xxhash64(id), 900) * 7 AS int) AS game_id"
    )
    index = gamemix.game_index(plays)
    rows = gamemix.sparse_vectors(plays, index)
    places = {r.game_id: r["index"] for r in index.collect()}
    assert sorted(places.values()) == list(range(len(places))) and sorted(places, key=places.get) == sorted(places)
    want = {}
    for r in gamemix.game_proportions(plays).collect():
        want.setdefault(r.user_id, {})[places[r.game_id]] = r.proportion
    for r in rows.collect():
        assert isinstance(r.features, SparseVector) and r.features.size == len(places)
        assert dict(zip(r.features.indices.tolist(), r.features.values.tolist())) == want.pop(r.user_id)
    assert not want
    model = KMeans(k=3, seed=1, maxIter=2).fit(rows)
    assert model.transform(rows).select("prediction").distinct().count() <= 3
    few = index.where("index < 5")
    with pytest.raises(Exception, match="not in the index"):
        gamemix.sparse_vectors(plays, few)
    none = plays.limit(0)
    assert gamemix.sparse_vectors(none, gamemix.game_index(none)).count() == 0


def test_game_index_in_many_ranges(spark):
    plays = spark.range(5000).selectExpr("id % 7 AS user_id", "cast(id * 3 AS int) AS game_id")
    spark.conf.set("spark.sql.shuffle.partitions", 11)
    try:
        got = {r.game_id: r["index"] for r in gamemix.game_index(plays).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert got == {3 * i: i for i in range(5000)}


def test_sketched_funnel_is_within_its_bound(spark):
    """Small sketches over days, against exact counts; and exact where they hold all users."""
    ids = spark.range(30_000).selectExpr("id AS user_id", "date_add(date'2024-01-01', cast(id % 20 AS int)) AS day")
    tables = {
        "subs": ids.unionAll(ids.where("user_id % 5 = 0")),
        "sessions": ids.where("user_id % 2 = 0"),
        "variety": ids.where("user_id % 3 <> 0").unionByName(ids.limit(5).withColumn("user_id", F.lit(None).cast("bigint"))),
        "demographics": ids.where("user_id < 20000"),
    }
    for lg_size, exact in ((10, False), (16, True)):
        parts = [sketches.daily_sketches(t, n, None if n == "demographics" else "day", lg_size) for n, t in tables.items()]
        stored = reduce(DataFrame.unionAll, parts).persist()
        assert stored.count() == 20 + 10 + 20 + 1
        for first, last in ((None, None), ("2024-01-03", "2024-01-12")):
            spans = {n: t if n == "demographics" else t.where(f"day BETWEEN '{first or '2000-01-01'}' AND '{last or '2100-01-01'}'") for n, t in tables.items()}
            want = {(r.step, r.side): r.users for r in matrix.join_funnel(*spans.values()).collect()}
            got = {(r.step, r.side): r.users for r in sketches.sketched_funnel(stored, first, last, lg_size).collect()}
            bound = 0 if exact else sketches.relative_error(lg_size) * 30_000
            assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= bound for k in want)
        stored.unpersist()
    empty = sketches.sketched_funnel(sketches.daily_sketches(ids.limit(0), "subs", "day"))
    assert [r.users for r in empty.collect()] == [0] * 7
    with pytest.raises(ValueError):
        sketches.daily_sketches(ids, "people")
