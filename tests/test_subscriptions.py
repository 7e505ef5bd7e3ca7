import random

import pandas as pd
import pytest

from tests.conftest import by_user, day
from tidemark.config import JobConfig
from tidemark.operators import subscriptions as subs

SCHEMA = "user_id bigint, rid bigint, date date, state string, workout_day int, gameplay_day int"


def activity(spark, dates_by_user):
    rows = [
        (u, i, day(d), "subs", 1, 1)
        for u, dates in dates_by_user.items()
        for i, d in enumerate(dates)
    ]
    return spark.createDataFrame(rows, SCHEMA)


FIXTURE = {
    1: ["2017-01-01", "2017-01-10", "2017-01-30", "2017-02-20"],
    2: ["2017-01-01", "2017-01-16"],
    3: ["2017-01-01"],
    4: ["2017-01-01", "2017-02-01", "2017-02-05"],
}


def test_churn_fixture(spark):
    got = by_user(
        subs.churn_summary(activity(spark, FIXTURE), 15), "date", "day_gap", "churned", "prior_churn_count"
    )
    assert got == {
        1: (day("2017-02-20"), 21, 1, 1),
        2: (day("2017-01-16"), 15, 0, 0),
        3: (day("2017-01-01"), None, 0, 0),
        4: (day("2017-02-01"), 31, 1, 0),
    }


def test_prior_count_as_written_is_zero(spark):
    got = by_user(subs.churn_summary(activity(spark, FIXTURE), 15, as_written=True), "prior_churn_count")
    assert set(got.values()) == {(0,)}


def test_day_gap_rows(spark):
    got = subs.day_gap(activity(spark, FIXTURE)).orderBy("user_id", "rid").collect()
    assert [r.day_gap for r in got] == [None, 9, 20, 21, None, 15, None, None, 31, 4]


def test_negative_threshold_is_refused(spark):
    with pytest.raises(ValueError):
        JobConfig(churn_threshold=-1)
    with pytest.raises(ValueError):
        subs.churn_summary(activity(spark, FIXTURE), -1)


def random_activity(spark, seed, hot_share=0.4, rows=1500):
    """One user holds 40 % of the rows; many rows share a date; some dates are missing."""
    rng = random.Random(seed)
    data = []
    ids = rng.sample(range(10 * rows), rows)
    for rid in ids:
        user = 0 if rng.random() < hot_share else rng.randrange(1, 60)
        date = pd.Timestamp("2020-01-01") + pd.Timedelta(days=rng.randrange(120 if user else 25) * 3)
        null = rng.random() < 0.01
        state = rng.choice(["subs", "free", None])
        data.append((user, rid, None if null else date.date(), state, rng.choice([None, 1, 2, 9]), rng.choice([None, 4])))
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def brute_rows(df):
    """Per-user gaps in (date, rid) order, undated rows first, in pandas."""
    pdf = df.toPandas()
    pdf["date"] = pd.to_datetime(pdf["date"])
    pdf = pdf.sort_values(["user_id", "date", "rid"], na_position="first")
    pdf["day_gap"] = pdf.groupby("user_id")["date"].diff().dt.days
    return pdf


@pytest.mark.parametrize("max_rows", [7, 50, 1_000_000])
def test_day_gap_matches_pandas_when_users_are_cut(spark, max_rows):
    df = random_activity(spark, 1)
    want = brute_rows(df).set_index("rid")["day_gap"]
    got = subs.day_gap(df, max_rows=max_rows).toPandas().set_index("rid")["day_gap"].astype("float64")
    assert len(got) == len(want)
    pd.testing.assert_series_equal(got.sort_index(), want.sort_index(), check_names=False)


@pytest.mark.parametrize("threshold", [0, 5, 40])
def test_summary_equals_row_by_row_definition(spark, threshold):
    df = random_activity(spark, 2)
    payload = ["workout_day", "gameplay_day", "state"]
    rows = brute_rows(df)
    rows["churned"] = (rows["day_gap"] > threshold).astype(int)
    counts = rows.groupby("user_id")["churned"].sum()
    kept = rows.sort_values(["churned", "date", "rid"], na_position="first").groupby("user_id").tail(1)
    got = subs.churn_summary(df, threshold, payload).toPandas().set_index("user_id")
    want = kept.set_index("user_id")
    assert set(got.index) == set(want.index)
    want = want.loc[got.index]
    assert (got["rid"] == want["rid"]).all()
    assert (got["churned"] == want["churned"]).all()
    assert (got["churn_count"] == counts.loc[got.index]).all()
    assert (got["prior_churn_count"] == counts.loc[got.index] - want["churned"]).all()
    for c in ["day_gap", "workout_day", "gameplay_day"]:
        pd.testing.assert_series_equal(got[c].astype("float64"), want[c].astype("float64"), check_names=False)
    assert (got["state"].fillna("-") == want["state"].fillna("-")).all()


def test_keep_one_row_equals_summary(spark):
    df = random_activity(spark, 3)
    rows = subs.churn_flag(subs.day_gap(df), 5)
    kept = by_user(subs.keep_one_row(rows), "rid", "churned")
    assert kept == by_user(subs.churn_summary(df, 5), "rid", "churned")


def test_features_fill_medians_then_drop_incomplete_rows(spark):
    rows = [
        (1, 1, day("2020-01-01"), "subs", 3, None),
        (2, 2, day("2020-01-01"), "free", None, 5),
        (3, 3, day("2020-01-01"), "free", 4, 8),
        (4, 4, day("2020-01-01"), None, 100, 6),
        (5, 5, day("2020-01-01"), "free", 1, 7),
        (5, 6, day("2020-01-03"), "free", 2, 7),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = by_user(subs.subscription_features(df), "workout_day", "gameplay_day", "churned", "prior_churn_count")
    # Medians of the kept rows: workout {3, 4, 100, 2} -> 3.5, gameplay {5, 8, 6, 7} -> 6.5.
    assert got == {1: (3.0, 6.5, 0, 0), 2: (3.5, 5.0, 0, 0), 3: (4.0, 8.0, 0, 0), 5: (2.0, 7.0, 0, 0)}


def test_without_any_gap_every_user_is_dropped(spark):
    """The median of no gaps is missing, so the filled gap is missing too."""
    df = activity(spark, {1: ["2020-01-01"], 2: ["2020-01-02"]})
    assert subs.subscription_features(df).count() == 0


def test_state_flag_is_optional(spark):
    df = activity(spark, FIXTURE)
    plain = subs.subscription_features(df)
    assert plain.columns == ["user_id", "workout_day", "gameplay_day", "churned", "prior_churn_count"]
    flagged = subs.subscription_features(df, JobConfig(keep_state_flag=True))
    assert by_user(flagged, "is_subs_acct")[1] == (1,)


def test_state_onehot_has_a_stable_schema(spark):
    df = spark.createDataFrame([(1, 1, day("2020-01-01"), None, 1, 1)], SCHEMA)
    row = subs.state_flags(df).first()
    assert (row.is_subs_acct, row.is_free, row.is_trial) == (0, 0, 0)


def test_users_without_id_vanish(spark):
    df = spark.createDataFrame([(None, 1, day("2020-01-01"), "subs", 1, 1)], SCHEMA)
    assert subs.churn_summary(df, 15).count() == 0
    assert subs.day_gap(df).count() == 0
